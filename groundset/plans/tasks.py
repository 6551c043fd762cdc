"""Queries of the grounding tasks and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundset.functions import geometry as G
from groundset.functions.text import ordinal
from groundset.operators import tasks
from groundset.session import table

BASE = """
WITH r AS (SELECT *, len(ls) AS n FROM (SELECT row_number() OVER () AS rid, doc_id, region_no, page_w AS w, page_h AS h, bbox AS b,
  list_filter(lines, lambda x: x.text IS NOT NULL AND trim(x.text, E' \\t\\n\\r') <> '' AND x.bbox IS NOT NULL AND x.bbox.x1 IS NOT NULL) AS ls FROM regions)
  WHERE len(ls) > 0 AND b IS NOT NULL AND w > 0 AND h > 0),
l AS (SELECT rid, doc_id, region_no, w, h, n, unnest(ls) AS x, generate_subscripts(ls, 1) - 1 AS i FROM r)"""


def _box(b: str, fmt: str, listed: bool = False) -> str:
    if fmt == "qwen":
        g = lambda v, d: f"CAST(greatest(0, least(1000, CAST(round_even(CAST({b}.{v} AS DOUBLE) / CAST({d} AS DOUBLE) * 1000, 0) AS INTEGER))) AS VARCHAR)"
        c = [g("x1", "w"), g("y1", "h"), g("x2", "w"), g("y2", "h")]
    else:
        c = [f"CAST({b}.{k} AS VARCHAR)" for k in ("x1", "y1", "x2", "y2")]
    if fmt == "qwen" or listed:
        return "'[' || " + " || ', ' || ".join(c) + " || ']'"
    return "'<location value=\"' || " + " || '\"/><location value=\"' || ".join(c) + " || '\"/>'"


def _list(fmt: str, ls: str = "ls") -> str:
    return f"'[' || array_to_string(list_transform({ls}, lambda y: {_box('y.bbox', fmt, True)}), ', ') || ']'"


def sql(mode: str, fmt: str, max_n: int = 3, seed: int = 42) -> str:
    note, rb, xb = G.note(fmt), _box("b", fmt), _box("x.bbox", fmt)
    row = lambda prompt, answer, source="l", where="": f"SELECT doc_id, region_no, {prompt} AS prompt, {answer} AS completion FROM {source} {where}"
    if mode == "bbox_to_text":
        p = f"'Transcribe the text inside the bounding box ' || {xb} || '.{note}'" if fmt == "qwen" else f"'Transcribe the text inside the element with these DocLang locations: ' || {xb} || '.'"
        return BASE + row(p, "x.text")
    if mode == "text_to_bbox":
        if fmt == "qwen":
            return BASE + row(f"'Predict the bounding box for the text \"' || x.text || '\".{note}'", xb)
        return BASE + row("'Emit the DocLang <text> element with its <location> coordinates for the text: \"' || x.text || '\".'", f"'<text>' || {xb} || x.text || '</text>'")
    if mode == "line_neighbor":
        out = []
        for direction, sign in (("above", "-"), ("below", "+")):
            for k in range(1, max_n + 1):
                nth = {1: "1st", 2: "2nd", 3: "3rd"}.get(k, f"{k}th")
                src = f"(SELECT a.*, t.x AS t FROM l a JOIN l t ON t.rid = a.rid AND t.i = a.i {sign} {k})"
                for ref, tail in (("'the line \"' || x.text || '\"'", ""), (f"'the line with bounding box ' || {xb}", note)):
                    out.append(row(f"'What is the text of the {nth} line {direction} ' || {ref} || '?{tail}'", "t.text", src))
                    out.append(row(f"'What is the bounding box of the {nth} line {direction} ' || {ref} || '?{note}'", _box("t.bbox", fmt), src))
        return BASE + " UNION ALL ".join(out)
    if mode == "region_to_lines":
        return BASE + row(f"'List the bounding boxes of all text lines in the paragraph ' || {rb} || ', in reading order.{note}'", _list(fmt), "r", "WHERE n >= 2")
    if mode == "lines_to_region":
        return BASE + row(f"'Given the text lines ' || {_list(fmt)} || ', what is the bounding box of the paragraph they belong to?{note}'", rb, "r", "WHERE n >= 2")
    if mode == "region_to_transcription":
        return BASE + row(f"'Transcribe all text lines in the paragraph ' || {rb} || ', in reading order.{note}'", "array_to_string(list_transform(ls, lambda y: y.text), E'\\n')", "r", "WHERE n >= 2")
    if mode == "line_index":
        answer = "'line ' || CAST(i + 1 AS VARCHAR) || ' of ' || CAST(n AS VARCHAR)"
        return BASE + row("'What is the position of the line \"' || x.text || '\" in its paragraph?'", answer, "l", "WHERE n >= 2") + " UNION ALL " + row(f"'What is the position of the line with bounding box ' || {xb} || ' in its paragraph?{note}'", answer, "l", "WHERE n >= 2")
    if mode == "line_ordering":
        return (
            BASE
            + f""", o AS (SELECT rid, list(i ORDER BY md5('{seed}|' || doc_id || '|' || CAST(region_no AS VARCHAR) || '|' || CAST(i AS VARCHAR)), i) AS o0, list(i ORDER BY i) AS ids, list(i ORDER BY i DESC) AS back FROM l WHERE n >= 3 GROUP BY rid),
s AS (SELECT r.*, CASE WHEN o0 = ids THEN back ELSE o0 END AS o, ids FROM r JOIN o USING (rid))
SELECT doc_id, region_no, 'These are the text lines of a paragraph in random order: ' || {_list(fmt, "list_transform(o, lambda j: ls[j + 1])")} || '. Give their reading order as 1-based indices.{note}' AS prompt,
  array_to_string(list_transform(ids, lambda p: CAST(list_position(o, p) AS VARCHAR)), ', ') AS completion FROM s"""
        )
    return BASE + row(f"'How many text lines are in the paragraph ' || {rb} || '?{note}'", "CAST(n AS VARCHAR)", "r")


def _query(mode: str, fmt: str):
    return lambda spark, sf_dir: tasks.build(table(spark, sf_dir, "regions"), mode, fmt)


QUERIES, ORACLE = {}, {}
for _mode in tasks.MODES:
    for _fmt in G.FORMATS:
        _name = _mode if _fmt == "qwen" else f"{_mode}_{_fmt}"
        QUERIES[_name] = _query(_mode, _fmt)
        ORACLE[_name] = sql(_mode, _fmt)


def polygon_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hull of all line boxes of a region, as points."""
    r = tasks.usable_regions(table(spark, sf_dir, "regions"))
    points = F.flatten(F.transform("ls", lambda x: F.array(F.struct(x["bbox"]["x1"].alias("x"), x["bbox"]["y1"].alias("y")), F.struct(x["bbox"]["x2"].alias("x"), x["bbox"]["y2"].alias("y")))))
    return r.select("doc_id", "region_no", G.hull(points).alias("h")).select("doc_id", "region_no", "h.*")


def region_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions that keep at least one usable line, with their number of lines."""
    return tasks.usable_regions(table(spark, sf_dir, "regions")).select("doc_id", "region_no", F.size("ls").cast("long").alias("n_lines"))


def ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordinals of the customers' keys."""
    return table(spark, sf_dir, "customer").select("c_custkey", ordinal(F.col("c_custkey")).alias("nth"))


QUERIES |= {"polygon_bbox": polygon_bbox, "regions": region_lines, "ordinal": ordinals}
ORACLE |= {
    "polygon_bbox": BASE + " SELECT doc_id, region_no, min(least(x.bbox.x1, x.bbox.x2)) AS x1, min(least(x.bbox.y1, x.bbox.y2)) AS y1, max(greatest(x.bbox.x1, x.bbox.x2)) AS x2, max(greatest(x.bbox.y1, x.bbox.y2)) AS y2 FROM l GROUP BY rid, doc_id, region_no",
    "regions": BASE + " SELECT doc_id, region_no, CAST(n AS BIGINT) AS n_lines FROM r",
    "ordinal": "SELECT c_custkey, CAST(c_custkey AS VARCHAR) || CASE WHEN c_custkey % 100 BETWEEN 10 AND 20 THEN 'th' WHEN c_custkey % 10 = 1 THEN 'st' WHEN c_custkey % 10 = 2 THEN 'nd' WHEN c_custkey % 10 = 3 THEN 'rd' ELSE 'th' END AS nth FROM customer",
}
