"""XML documents as node tables, and node tables of pages as regions.

The shredder is the one place where Python parses: one document in, its nodes out, with
pre-order numbers, the end of each subtree, depth, place among siblings, slot and text runs.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundset.functions import geometry as G
from groundset.functions.text import strip, xml_attribute, xml_text

NODES = "doc_id string, node_id int, parent_id int, subtree_end int, depth int, ordinal int, tag string, slot string, attrs map<string,string>, text string, path string, parent_tag string, parent_class string, item_id int, region_id int, shut_id int, error string"
#: Fixed value: the element heads of the markup, in their order.
HEAD_TAGS = ("label", "thread", "xref", "href", "layer", "location", "caption", "description", "summary", "custom")
#: Fixed value: the namespace of page files.
PAGE_NAMESPACE = "http://schema.primaresearch.org/PAGE/gts/pagecontent/2013-07-15"
#: Elements that hold no text of the element around them.
SHUT = ("list", "table", "index")
#: The roots of the two kinds of files.
ROOTS = ("PcGts", "doclang")


def _name(tag: str) -> str:
    return tag.rpartition("}")[2]


def shred_text(text: str, roots: tuple[str, ...] | None = None) -> tuple[list[tuple], str | None]:
    """(nodes, error) of one document of any size.

    A document type is refused wherever it stands, since inputs aren't trusted; so are a root
    that isn't one of ``roots``, and elements of a second namespace.
    """
    if "<!DOCTYPE" in text or "<!ENTITY" in text:
        return [], "document type"
    parser = ET.XMLPullParser(("start", "end"))
    rows: list[list] = []
    stack: list[dict] = []

    def run(owner: dict, value: str | None) -> None:
        if value:
            rows.append([len(rows), owner["id"], len(rows), len(stack), owner["n"], "#text", owner["slot"], None, value, owner["path"] + "/#text", *owner["inside"]])
            owner["n"] += 1

    try:
        parser.feed(text)
        parser.close()
        for event, el in parser.read_events():
            tag = _name(el.tag)
            if event == "start":
                owner = stack[-1] if stack else None
                if owner is None:
                    space = el.tag[: -len(tag)]
                    if roots is not None and tag not in roots:
                        return [], f"root element {tag}"
                elif el.tag[: -len(tag)] != space:
                    return [], f"second namespace {el.tag[: -len(tag)]}"
                if owner is not None and owner.get("last") is None and not owner["opened"]:
                    run(owner, owner["el"].text)
                    owner["opened"] = True
                elif owner is not None and owner.get("last") is not None:
                    run(owner, owner["last"].tail)
                slot = "body"
                if owner is not None and owner["head"] and tag in HEAD_TAGS:
                    slot = "head"
                elif owner is not None:
                    owner["head"] = False
                if owner is not None and owner["slot"] == "head":
                    slot = "head"
                path = (owner["path"] if owner else "") + "/" + tag
                around = owner["inside"] if owner else (None,) * 5  # what the element lies in: its parent's tag and class, the nearest field item, field region and shut element
                me = len(rows)
                inside = (tag, el.attrib.get("class"), me if tag == "field_item" else around[2], me if tag == "field_region" else around[3], me if tag in SHUT else around[4])
                node = {"id": me, "el": el, "n": 0, "head": True, "slot": slot, "path": path, "opened": False, "last": None, "inside": inside}
                rows.append([me, owner["id"] if owner else None, None, len(stack), owner["n"] if owner else 0, tag, slot, [(_name(k), v) for k, v in el.attrib.items()], None, path, *around])
                if owner is not None:
                    owner["n"] += 1
                stack.append(node)
            else:
                node = stack.pop()
                if not node["opened"] and node["last"] is None:
                    run_stack_text(rows, node, el.text, len(stack) + 1)
                elif node["last"] is not None:
                    run_stack_text(rows, node, node["last"].tail, len(stack) + 1)
                rows[node["id"]][2] = len(rows) - 1
                if stack:
                    stack[-1]["last"] = el
                    stack[-1]["opened"] = True
    except ET.ParseError as e:
        return [], str(e)
    return [tuple(r) for r in rows], None


def run_stack_text(rows: list[list], node: dict, value: str | None, depth: int) -> None:
    if value:
        rows.append([len(rows), node["id"], len(rows), depth, node["n"], "#text", node["slot"], None, value, node["path"] + "/#text", *node["inside"]])
        node["n"] += 1


def shred(docs: DataFrame, key: str, content: str, roots: tuple[str, ...] | None = None) -> DataFrame:
    """The node table of XML texts. A text that can't be parsed, of a foreign root or of two namespaces gives one row with its error; null gives nothing."""
    fields = [("doc_id", pa.string()), ("node_id", pa.int32()), ("parent_id", pa.int32()), ("subtree_end", pa.int32()), ("depth", pa.int32()), ("ordinal", pa.int32()), ("tag", pa.string()), ("slot", pa.string()), ("attrs", pa.map_(pa.string(), pa.string())), ("text", pa.string()), ("path", pa.string()), ("parent_tag", pa.string()), ("parent_class", pa.string()), ("item_id", pa.int32()), ("region_id", pa.int32()), ("shut_id", pa.int32()), ("error", pa.string())]
    schema = pa.schema(fields)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if text is None:
                    continue
                nodes, error = shred_text(text, roots)
                rows += [(doc, *n, None) for n in nodes] if error is None else [(doc, *[None] * 15, error)]
                if len(rows) > 20_000:
                    yield batch(rows)
                    rows = []
            if rows:
                yield batch(rows)

    return docs.select(F.col(key).cast("string").alias("doc_id"), F.col(content).alias("content")).mapInArrow(run, NODES)


def scan_documents(spark, path: str, suffixes: tuple[str, ...] = (".xml", ".dclg")) -> DataFrame:
    """Files of a folder, not of its subfolders: path, stem, suffix, rank (order of the suffixes), content."""
    parts = []
    for rank, s in enumerate(suffixes):
        f = spark.read.format("binaryFile").option("pathGlobFilter", f"*{s}").load(path)
        parts.append(f.select("path", F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("stem"), F.lit(s).alias("suffix"), F.lit(rank).alias("rank"), F.decode("content", "UTF-8").alias("content")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def page_xml(regions: DataFrame, namespace: str = PAGE_NAMESPACE) -> DataFrame:
    """(doc_id, content): a page file from the regions of a page, in their order."""
    def points(b: Column) -> Column:
        return F.concat(b["x1"].cast("string"), F.lit(","), b["y1"].cast("string"), F.lit(" "), b["x2"].cast("string"), F.lit(","), b["y1"].cast("string"), F.lit(" "), b["x2"].cast("string"), F.lit(","), b["y2"].cast("string"), F.lit(" "), b["x1"].cast("string"), F.lit(","), b["y2"].cast("string"))

    coords = lambda b: F.when(b["x1"].isNotNull(), F.concat(F.lit('<Coords points="'), points(b), F.lit('"/>'))).otherwise("")
    line = lambda x: F.concat(
        F.lit('<TextLine id="'), xml_attribute(F.coalesce(x["line_id"], F.lit(""))), F.lit('"'),
        F.when(x["reading_order"].isNotNull(), F.concat(F.lit(' custom="readingOrder {index:'), x["reading_order"].cast("string"), F.lit(';}"'))).otherwise(""),
        F.lit(">"), coords(x["bbox"]), F.lit("<TextEquiv><Unicode>"), xml_text(F.coalesce(x["text"], F.lit(""))), F.lit("</Unicode></TextEquiv></TextLine>"),
    )
    region = F.concat(F.lit('<TextRegion id="'), xml_attribute(F.col("region_id")), F.lit('">'), coords(F.col("bbox")), F.coalesce(F.array_join(F.transform("lines", line), ""), F.lit("")), F.lit("</TextRegion>"))
    page = regions.where("region_no IS NOT NULL AND region_id IS NOT NULL").select("doc_id", "page_w", "page_h", F.struct("region_no", region.alias("r")).alias("s")).groupBy("doc_id").agg(F.max("page_w").alias("w"), F.max("page_h").alias("h"), F.array_sort(F.collect_list("s")).alias("rs"))
    body = F.array_join(F.transform("rs", lambda s: s["r"]), "")
    return page.select("doc_id", F.concat(F.lit(f'<?xml version="1.0" encoding="UTF-8"?><PcGts xmlns="{namespace}"><Metadata/><Page imageFilename="'), xml_attribute(F.col("doc_id")), F.lit('.png" imageWidth="'), F.col("w").cast("string"), F.lit('" imageHeight="'), F.col("h").cast("string"), F.lit('">'), body, F.lit("</Page></PcGts>")).alias("content"))


def with_size(content: Column, width: Column, height: Column) -> Column:
    """A page file with another declared size; null numbers leave the one it has."""
    for name, value in (("imageWidth", width), ("imageHeight", height)):
        content = F.when(value.isNull(), content).otherwise(F.regexp_replace(content, F.lit(rf'(<Page\b[^>]*?\b{name}=")[^"]*'), F.concat(F.lit("$1"), value.cast("string"))))
    return content


def page_lines(nodes: DataFrame) -> DataFrame:
    """Every line of page files: doc_id, region_id, line_id, line_no (over the page), custom, points, text.

    Lines are linked to what lies in them by their node numbers. The text is that of the
    first Unicode element, else of the first child of a TextEquiv that has one, null if there
    is none; lines outside regions have a null region_id.
    """
    line = nodes.where("tag = 'TextLine'").select("doc_id", F.col("node_id").alias("a"), F.col("subtree_end").alias("z"), "parent_id", F.coalesce(F.col("attrs")["id"], F.lit("None")).alias("line_id"), F.col("attrs")["custom"].alias("custom"))
    inner = nodes.where("tag IN ('Coords', 'Baseline') OR (tag = '#text' AND path RLIKE '/TextLine/TextEquiv/[^/]+/#text$')").select(F.col("doc_id").alias("d"), "node_id", "tag", "text", F.col("attrs")["points"].alias("points"), "path")
    j = line.join(inner, (F.col("doc_id") == F.col("d")) & (F.col("node_id") > F.col("a")) & (F.col("node_id") <= F.col("z")), "left")
    out = j.groupBy("doc_id", "a", "parent_id", "line_id", "custom").agg(F.min_by("points", F.when(F.col("tag") == "Coords", F.col("node_id"))).alias("points"), F.min_by("text", F.when(F.col("tag") == "#text", F.struct(~F.col("path").endswith("/Unicode/#text"), F.col("node_id")))).alias("text"), F.min_by("points", F.when(F.col("tag") == "Baseline", F.col("node_id"))).alias("baseline"))
    region = nodes.where("tag = 'TextRegion'").select("doc_id", F.col("node_id").alias("parent_id"), F.coalesce(F.col("attrs")["id"], F.lit("None")).alias("region_id"))
    return out.join(region, ["doc_id", "parent_id"], "left").select("doc_id", "region_id", "line_id", F.col("a").alias("line_no"), "custom", "points", "baseline", "text")


def lines_with_coords(lines: DataFrame) -> DataFrame:
    """Lines whose points can be read, with their hull."""
    return lines.withColumn("bbox", G.hull(G.parse_points(F.col("points")))).where("bbox IS NOT NULL")


def zones(nodes: DataFrame, tags: list[str]) -> DataFrame:
    """(doc_id, zone, node_id, tag): a running number over the wanted elements, by the order of the names, then of the page."""
    from pyspark.sql import Window

    rank = F.array_position(F.array(*[F.lit(t) for t in tags]), F.col("tag"))
    z = nodes.where(F.col("tag").isin(*tags)).withColumn("rank", rank)
    return z.withColumn("zone", F.row_number().over(Window.partitionBy("doc_id").orderBy("rank", "node_id")) - 1).select("doc_id", "zone", "node_id", "tag")


def baselines(lines: DataFrame) -> DataFrame:
    """Baselines as points; a single point is doubled, empty ones are left out."""
    p = G.parse_points(F.col("baseline"))
    return lines.select("doc_id", "line_id", F.when(F.size(p) == 1, F.concat(p, p)).otherwise(p).alias("points")).where("points IS NOT NULL")


def class_polygons(nodes: DataFrame, classes: dict[str, int], of: Column) -> DataFrame:
    """(doc_id, region_id, class_id, points) of regions whose type is known and whose polygon has three points or more.

    A region and the Coords in it meet by one grouping of one pass over the nodes, not by a join
    of two, as the size of nodes is unknown before they are there and a side of them that seems small may be broadcast.
    """
    region, known = F.col("tag") == "TextRegion", F.create_map(*[F.lit(x) for kv in classes.items() for x in kv])
    of_class = nodes.where("tag = 'TextRegion' OR (tag = 'Coords' AND parent_tag = 'TextRegion')").select("doc_id", F.when(region, F.col("node_id")).otherwise(F.col("parent_id")).alias("a"), F.when(region, F.struct(F.col("attrs")["id"].alias("region_id"), F.try_element_at(known, of).alias("class_id"))).alias("r"), F.when(~region, F.col("attrs")["points"]).alias("p"))
    both = of_class.where("doc_id IS NOT NULL").groupBy("doc_id", "a").agg(F.collect_list("r").alias("r"), F.collect_list("p").alias("p")).select("doc_id", F.explode("r").alias("r"), "p").where("r.class_id IS NOT NULL")
    return both.select("doc_id", "r.*", F.explode("p").alias("p")).select("doc_id", "region_id", "class_id", G.parse_points(F.col("p")).alias("points")).where("size(points) >= 3")


def declared_size(nodes: DataFrame) -> DataFrame:
    """(doc_id, width, height) of a page or of the first resolution with both."""
    page = nodes.where("tag = 'Page' OR (tag = 'default_resolution' AND attrs['width'] IS NOT NULL AND attrs['height'] IS NOT NULL)")
    w = F.coalesce(F.col("attrs")["imageWidth"], F.col("attrs")["width"]).try_cast("int")
    h = F.coalesce(F.col("attrs")["imageHeight"], F.col("attrs")["height"]).try_cast("int")
    return page.groupBy("doc_id").agg(F.min_by(F.struct(w.alias("width"), h.alias("height")), "node_id").alias("s")).select("doc_id", "s.*").where("width IS NOT NULL AND height IS NOT NULL")
