"""The nine grounding tasks: a region with its lines becomes (prompt, completion) pairs.

Every task is one projection over the nested lines and one explode, so none of them shuffles
and neighbours are read from the array instead of a self join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundset.functions import geometry as G
from groundset.functions.text import strip

MODES = ("bbox_to_text", "text_to_bbox", "line_neighbor", "region_to_lines", "lines_to_region", "region_to_transcription", "line_index", "line_ordering", "line_count")
LINES = f"array<struct<text:string,bbox:{G.BOX}>>"


def whole_box(box: Column) -> Column:
    return box.isNotNull() & box["x1"].isNotNull() & box["y1"].isNotNull() & box["x2"].isNotNull() & box["y2"].isNotNull()


def usable_regions(regions: DataFrame) -> DataFrame:
    """doc_id, region_no, page_w, page_h, bbox, ls: regions with at least one line that has text and a box, in document order.

    Lines with null or blank text or without a whole box are left out; so are regions without
    a box or with a page of no size, and those left with no line.
    """
    kept = F.filter("lines", lambda x: x.isNotNull() & (F.length(strip(F.coalesce(x["text"], F.lit("")))) > 0) & whole_box(x["bbox"]))
    ls = F.transform(kept, lambda x: F.struct(strip(x["text"]).alias("text"), x["bbox"].alias("bbox")))
    out = regions.select("doc_id", "region_no", "page_w", "page_h", "bbox", ls.alias("ls"))
    return out.where((F.size("ls") > 0) & whole_box(F.col("bbox")) & (F.col("page_w") > 0) & (F.col("page_h") > 0))


def _pair(prompt: Column, completion: Column) -> Column:
    return F.struct(prompt.alias("prompt"), completion.alias("completion"))


def _say(*parts: object) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def pairs(mode: str, fmt: str, max_n: int = 3) -> Column:
    """The array of (prompt, completion) structs of one prepared row.

    Prepared rows have the region's columns, ``region`` and ``boxes`` as text, and in the
    modes of LINE_MODES the line at hand as ``x`` with its place ``i``; every line carries
    its box as text in ``fb``, so a box is written once however often it is named.
    """
    ls, n = F.col("ls"), F.size("ls")
    region, boxes = F.col("region"), F.col("boxes")
    note = G.note(fmt)
    x, i = F.col("x"), F.col("i")
    none = F.expr("cast(array() as array<struct<prompt:string,completion:string>>)")

    def at_least(k: int, value: Column) -> Column:
        return F.when(n >= k, value).otherwise(none)

    if mode == "bbox_to_text":
        if fmt == "qwen":
            return F.array(_pair(_say("Transcribe the text inside the bounding box ", x["fb"], ".", note), x["text"]))
        return F.array(_pair(_say("Transcribe the text inside the element with these DocLang locations: ", x["fb"], "."), x["text"]))
    if mode == "text_to_bbox":
        if fmt == "qwen":
            return F.array(_pair(_say('Predict the bounding box for the text "', x["text"], '".', note), x["fb"]))
        return F.array(_pair(_say('Emit the DocLang <text> element with its <location> coordinates for the text: "', x["text"], '".'), _say("<text>", x["fb"], x["text"], "</text>")))
    if mode == "line_neighbor":
        cases = []
        for direction, sign in (("above", -1), ("below", 1)):
            for k in range(1, max_n + 1):
                target = F.get(ls, i + sign * k)
                there = (i + sign * k >= 0) & (i + sign * k < n)
                nth = _nth(k)
                for ref, tail in ((_say('the line "', x["text"], '"'), ""), (_say("the line with bounding box ", x["fb"]), note)):
                    cases.append(F.when(there, _pair(_say(f"What is the text of the {nth} line {direction} ", ref, "?", tail), target["text"])))
                    cases.append(F.when(there, _pair(_say(f"What is the bounding box of the {nth} line {direction} ", ref, "?", note), target["fb"])))
        return F.array_compact(F.array(*cases))
    if mode == "region_to_lines":
        return at_least(2, F.array(_pair(_say("List the bounding boxes of all text lines in the paragraph ", region, ", in reading order.", note), boxes)))
    if mode == "lines_to_region":
        return at_least(2, F.array(_pair(_say("Given the text lines ", boxes, ", what is the bounding box of the paragraph they belong to?", note), region)))
    if mode == "region_to_transcription":
        return at_least(2, F.array(_pair(_say("Transcribe all text lines in the paragraph ", region, ", in reading order.", note), F.array_join(ls["text"], "\n"))))
    if mode == "line_index":
        answer = F.concat(F.lit("line "), (i + 1).cast("string"), F.lit(" of "), n.cast("string"))
        return at_least(2, F.array(_pair(_say('What is the position of the line "', x["text"], '" in its paragraph?'), answer), _pair(_say("What is the position of the line with bounding box ", x["fb"], " in its paragraph?", note), answer)))
    if mode == "line_ordering":
        order = F.col("order")
        shown = G.format_box_list(F.transform(order, lambda k: F.get(ls, k)["bbox"]), F.col("page_w"), F.col("page_h"), fmt)
        answer = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda p: F.array_position(order, p).cast("string")), ", ")
        return at_least(3, F.array(_pair(_say("These are the text lines of a paragraph in random order: ", shown, ". Give their reading order as 1-based indices.", note), answer)))
    if mode == "line_count":
        return F.array(_pair(_say("How many text lines are in the paragraph ", region, "?", note), n.cast("string")))
    raise ValueError(f"unknown mode: {mode}")


def _nth(k: int) -> str:
    """An ordinal as a constant of the plan."""
    return f"{k}{'th' if 10 <= k % 100 <= 20 else {1: 'st', 2: 'nd', 3: 'rd'}.get(k % 10, 'th')}"


def _shuffle(seed: int) -> Column:
    """A shuffle every engine can repeat: lines sorted by the digest of seed, region and place, reversed if that changes nothing."""
    n = F.size("ls")
    keyed = F.transform("ls", lambda x, i: F.struct(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("doc_id"), F.col("region_no").cast("string"), i.cast("string"))).alias("h"), i.alias("i")))
    order = F.transform(F.array_sort(keyed), lambda s: s["i"])
    return F.when(order == F.sequence(F.lit(0), n - 1), F.sequence(n - 1, F.lit(0))).otherwise(order)


LINE_MODES = ("bbox_to_text", "text_to_bbox", "line_neighbor", "line_index")


def prepare(regions: DataFrame, mode: str, fmt: str, seed: int = 42) -> DataFrame:
    """Rows that ``pairs`` reads. The explodes also keep what they hold from being computed again for each use."""
    w, h = F.col("page_w"), F.col("page_h")
    r = usable_regions(regions)
    if mode in LINE_MODES:
        # the box as text is written once a line, in the projection below an explode
        with_box = F.transform("ls", lambda x: F.struct(x["text"].alias("text"), x["bbox"].alias("bbox"), G.format_box(x["bbox"], w, h, fmt).alias("fb")))
        r = r.select("doc_id", "region_no", F.explode(F.array(with_box)).alias("ls"), F.lit(None).cast("string").alias("region"), F.lit(None).cast("string").alias("boxes"))
        return r.select("*", F.posexplode("ls").alias("i", "x"))
    boxes = G.format_box_list(F.transform("ls", lambda x: x["bbox"]), w, h, fmt)
    r = r.select("*", G.format_box(F.col("bbox"), w, h, fmt).alias("region"), boxes.alias("boxes"))
    return r.select("*", F.explode(F.array(_shuffle(seed))).alias("order")) if mode == "line_ordering" else r


def build(regions: DataFrame, mode: str, fmt: str, max_n: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, region_no, prompt, completion) of one task in one box format."""
    if fmt not in G.FORMATS:
        raise ValueError(f"unknown format: {fmt}")
    if max_n < 1:
        raise ValueError("max_n must be at least 1")
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode}")
    return prepare(regions, mode, fmt, seed).select("doc_id", "region_no", F.explode(pairs(mode, fmt, max_n)).alias("c")).select("doc_id", "region_no", "c.prompt", "c.completion")


#: Task name -> function of (regions, format), as the entry points take it.
TASKS: dict[str, Callable[..., DataFrame]] = {m: (lambda m: lambda regions, fmt, **kw: build(regions, m, fmt, **kw))(m) for m in MODES}


def as_records(candidates: DataFrame) -> DataFrame:
    """Training records (prompt, completion, images) of candidates with a path: the user's image and text, the assistant's text."""
    block = lambda kind, text: F.struct(F.lit(kind).alias("type"), text.alias("text"))
    none = F.lit(None).cast("string")
    user = F.struct(F.lit("user").alias("role"), F.array(block("image", none), block("text", F.col("prompt"))).alias("content"))
    answer = F.struct(F.lit("assistant").alias("role"), F.array(block("text", F.col("completion"))).alias("content"))
    return candidates.select(F.array(user).alias("prompt"), F.array(answer).alias("completion"), F.array(F.struct(F.col("path").alias("path"))).alias("images"))
