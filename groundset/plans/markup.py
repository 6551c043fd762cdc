"""Queries of page files and of the structured markup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundset.operators import markup
from groundset.functions.text import strip
from groundset.operators.pages import first_image, nonblank, region_type
from groundset.session import table
from groundset.sources import xml


def _delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last delivery of every document."""
    d = table(spark, sf_dir, "doclang_docs")
    return d.groupBy("doc_id").agg(F.max_by(F.struct("head", "body"), F.struct("ingested_at", "record_id")).alias("x")).select("doc_id", "x.*")


def _content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.serialize(_delivered(spark, sf_dir), "doc_id")


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return xml.shred(_content(spark, sf_dir), "doc_id", "content")


def _page_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return xml.shred(page_write(spark, sf_dir), "doc_id", "content")


def page_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    return xml.page_xml(table(spark, sf_dir, "regions").dropDuplicates(["doc_id", "region_no"]))


def page_shred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_nodes(spark, sf_dir).groupBy("tag").agg(F.count("*").alias("nodes"))


def page_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the pages written as files and read again."""
    n = xml.page_lines(_page_nodes(spark, sf_dir))
    return n.select("doc_id", "region_id", "line_id", F.coalesce("text", F.lit("")).alias("text"))


def line_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return xml.page_lines(_page_nodes(spark, sf_dir)).where("points IS NOT NULL").select("doc_id", "region_id", "line_id", "points")


def lines_with_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return xml.lines_with_coords(xml.page_lines(_page_nodes(spark, sf_dir))).select("doc_id", "region_id", "line_id", "bbox.*")


def baseline_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baselines from the lower edge of each line's box."""
    lines = xml.lines_with_coords(xml.page_lines(_page_nodes(spark, sf_dir)))
    b = lines.withColumn("baseline", F.concat(F.col("bbox.x1"), F.lit(","), F.col("bbox.y2"), F.lit(" "), F.col("bbox.x2"), F.lit(","), F.col("bbox.y2")))
    return xml.baselines(b).select("doc_id", "line_id", F.size("points").cast("long").alias("n"), F.col("points")[0]["y"].alias("y"))


def class_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions by the class of their type; the first two regions of a page count as heads here."""
    kind = F.when(F.coalesce(region_type(F.col("attrs")["custom"]), F.lit("")) != "", region_type(F.col("attrs")["custom"])).when(F.col("attrs")["id"].rlike("(^r|_0*)[12]$"), "heading").otherwise("paragraph")
    p = xml.class_polygons(_page_nodes(spark, sf_dir), {"paragraph": 1, "heading": 2}, kind)
    return p.select("doc_id", "region_id", "class_id", F.size("points").cast("long").alias("n_points"))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return xml.zones(_page_nodes(spark, sf_dir), ["TextRegion", "TextLine"]).select("doc_id", "zone", "tag")


def declared_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared sizes of page files and of markup documents."""
    return xml.declared_size(_page_nodes(spark, sf_dir)).unionByName(xml.declared_size(_nodes(spark, sf_dir)))


def doclang_serialize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _content(spark, sf_dir)


def doclang_shred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements of the rendered documents by tag, without content, whose number depends on the blanks at the edges of runs."""
    return _nodes(spark, sf_dir).where("tag NOT IN ('#text', 'content')").groupBy("tag").agg(F.count("*").alias("nodes"))


def violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.violations(_nodes(spark, sf_dir))


def markup_sft(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that break no rule, with an image, as transcription-to-markup records."""
    c = _content(spark, sf_dir)
    ok = markup.valid_documents(c, markup.violations(xml.shred(c, "doc_id", "content")))
    pics = first_image(_document_images(spark, sf_dir)).withColumnRenamed("stem", "doc_id")
    return ok.join(pics, "doc_id").select("doc_id", F.lit(markup.PROMPT).alias("prompt"), strip(F.col("content")).alias("completion"), "path")


def _document_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images under the names of documents: those of pages are given to the documents in their order, so every third has none."""
    docs = _delivered(spark, sf_dir).select("doc_id", F.pmod(F.crc32(F.col("doc_id").cast("binary")), F.lit(3)).alias("k"))
    both = F.array(F.struct(F.lit(".png").alias("ext")), F.struct(F.lit(".jpg").alias("ext")))
    return docs.where("k > 0").select("doc_id", F.explode(F.when(F.col("k") == 1, F.slice(both, 1, 1)).otherwise(both)).alias("e")).select(F.col("doc_id").alias("stem"), "e.ext", F.concat(F.lit("images/"), F.col("doc_id"), F.col("e.ext")).alias("path"))


def node_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.node_text(_nodes(spark, sf_dir), "text").select("doc_id", "text")


def four_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.text_pairs(_nodes(spark, sf_dir)).select("doc_id", "text", "bbox.*")


def pairs_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(text, box) pairs of page files, then of markup documents."""
    a = nonblank(xml.lines_with_coords(xml.page_lines(_page_nodes(spark, sf_dir))).withColumn("text", F.coalesce("text", F.lit(""))), "text").select(F.lit(0).alias("rank"), "doc_id", "text", "bbox.*")
    b = markup.text_pairs(_nodes(spark, sf_dir)).select(F.lit(1).alias("rank"), "doc_id", "text", "bbox.*")
    return a.unionByName(b)


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.coverage(_nodes(spark, sf_dir))


def mutants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mutants of the documents with the rules each mutation breaks anew."""
    c = _content(spark, sf_dir)
    m = markup.mutants(c).withColumn("doc_id", F.concat_ws("|", "doc_id", "mutation")).select("doc_id", "content")
    v = markup.violations(xml.shred(m, "doc_id", "content"))
    return v.groupBy(F.substring_index("doc_id", "|", -1).alias("mutation"), "rule").agg(F.count_distinct("doc_id").alias("mutants"))


QUERIES = {
    "page_write": page_write, "page_shred": page_shred, "page_round_trip": page_round_trip, "line_coords": line_coords, "lines_with_coords": lines_with_coords, "baseline_coords": baseline_coords, "class_coords": class_coords, "zones": zones,
    "declared_size": declared_size, "doclang_serialize": doclang_serialize, "doclang_shred": doclang_shred, "violations": violations, "markup_sft": markup_sft, "node_text": node_text, "four_locations": four_locations, "pairs_union": pairs_union,
    "coverage": coverage, "mutants": mutants,
}
_LAST = "(SELECT doc_id, arg_max(head, (ingested_at, record_id)) AS head, arg_max(body, (ingested_at, record_id)) AS body FROM (SELECT doc_id, record_id, ingested_at, coalesce(head, '') AS head, coalesce(body, '') AS body FROM doclang_docs) GROUP BY doc_id)"
_RENDERED = f"(SELECT * FROM {_LAST} WHERE json_valid(body) AND json_type(body) = 'ARRAY')"
_CLASS = "CASE WHEN regexp_matches(region_id, '(^r|_0*)[12]$') THEN 2 ELSE 1 END"
_R = "(SELECT DISTINCT doc_id, region_no, region_id, lines FROM regions)"
_TYPED = f"(SELECT d.doc_id, json_extract_string(j.value, '$.type') AS type, json_extract_string(j.value, '$.text') AS text FROM {_RENDERED} d, json_tree(d.body) j WHERE j.type = 'OBJECT' UNION ALL SELECT d.doc_id, json_extract_string(j.value, '$.type'), NULL FROM {_RENDERED} d, json_tree(d.head) j WHERE d.head <> '' AND j.type = 'OBJECT')"
_BLANKS = "[\\s\\x{0b}\\x{1c}-\\x{1f}\\x{85}\\pZ]"


def _escaped(text: str, quote: bool = True) -> str:
    """SQL of an escaped text."""
    out = f"replace(replace(replace({text}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    return f"replace({out}, '\"', '&quot;')" if quote else out


def _coords(b: str) -> str:
    """SQL of a Coords element around a box, nothing for none."""
    points = f"{b}.x1 || ',' || {b}.y1 || ' ' || {b}.x2 || ',' || {b}.y1 || ' ' || {b}.x2 || ',' || {b}.y2 || ' ' || {b}.x1 || ',' || {b}.y2"
    return f"CASE WHEN {b}.x1 IS NOT NULL THEN '<Coords points=\"' || {points} || '\"/>' ELSE '' END"


#: SQL of u (doc_id, tag): the elements each document uses.
USED_TAGS = f"""WITH u AS (SELECT doc_id, type AS tag FROM {_TYPED} WHERE type IS NOT NULL AND type <> 'text_chunk' UNION SELECT doc_id, 'content' FROM {_TYPED} WHERE type = 'text_chunk' AND regexp_matches(text, '^[\\s\\x{{0b}}\\x{{1c}}-\\x{{1f}}\\x{{85}}\\pZ]|[\\s\\x{{0b}}\\x{{1c}}-\\x{{1f}}\\x{{85}}\\pZ]$')
  UNION SELECT doc_id, 'doclang' FROM {_RENDERED} UNION SELECT doc_id, 'head' FROM {_RENDERED} WHERE head NOT IN ('', 'null'))"""
#: SQL of e (text elements: doc_id, key, id, box, text) of the typed bodies; runs inside heads, lists and tables don't belong to an element around those.
_TEXTS = f"""WITH n AS (SELECT d.doc_id, j.fullkey AS key, j.id, json_extract_string(j.value, '$.type') AS type, j.value AS v FROM {_RENDERED} d, json_tree(d.body) j WHERE j.type = 'OBJECT'),
runs AS (SELECT doc_id, key, id, json_extract_string(v, '$.text') AS t FROM n WHERE type IN ('text_chunk', 'content')),
el AS (SELECT doc_id, key, id, json_extract(v, '$.head.locations') AS loc FROM n WHERE type = 'text'),
e AS (SELECT el.doc_id, el.key, el.id, el.loc, coalesce(string_agg(runs.t, '' ORDER BY runs.id), '') AS text FROM el LEFT JOIN runs ON runs.doc_id = el.doc_id AND starts_with(runs.key, el.key || '.') AND NOT contains(runs.key, '.head.')
  AND NOT regexp_matches(substr(runs.key, length(el.key) + 1), '\\.(items|cells)\\[') GROUP BY ALL)"""
_BOXES = f"""SELECT doc_id, regexp_replace(text, '^{_BLANKS}+|{_BLANKS}+$', '', 'g') AS text, CAST(json_extract_string(loc, '$[0].value') AS INTEGER) AS x1, CAST(json_extract_string(loc, '$[1].value') AS INTEGER) AS y1, CAST(json_extract_string(loc, '$[2].value') AS INTEGER) AS x2, CAST(json_extract_string(loc, '$[3].value') AS INTEGER) AS y2
FROM e WHERE json_array_length(loc) = 4 AND regexp_matches(text, '[^\\s\\x{{0b}}\\x{{1c}}-\\x{{1f}}\\x{{85}}\\pZ]')"""
ORACLE = {
    "coverage": USED_TAGS + f""", v AS (SELECT unnest([{", ".join(repr(t) for t in markup.VOCABULARY)}]) AS tag)
SELECT v.tag, count(DISTINCT u.doc_id) AS documents FROM v LEFT JOIN u ON u.tag = v.tag GROUP BY v.tag""",
    "page_write": f"""WITH l AS (SELECT DISTINCT ON (doc_id, region_no) doc_id, region_no, page_w, page_h, '<TextRegion id="' || {_escaped("region_id")} || '">' || {_coords("bbox")} || coalesce(array_to_string(list_transform(lines, lambda x:
  '<TextLine id="' || {_escaped("coalesce(x.line_id, '')")} || '"' || CASE WHEN x.reading_order IS NOT NULL THEN ' custom="readingOrder {{index:' || CAST(x.reading_order AS VARCHAR) || ';}}"' ELSE '' END || '>' || {_coords("x.bbox")} || '<TextEquiv><Unicode>' || {_escaped("coalesce(x.text, '')", False)} || '</Unicode></TextEquiv></TextLine>'), ''), '') || '</TextRegion>' AS r
  FROM regions WHERE region_no IS NOT NULL AND region_id IS NOT NULL)
SELECT doc_id, '<?xml version="1.0" encoding="UTF-8"?><PcGts xmlns="{xml.PAGE_NAMESPACE}"><Metadata/><Page imageFilename="' || {_escaped("doc_id")} || '.png" imageWidth="' || max(page_w) || '" imageHeight="' || max(page_h) || '">' || string_agg(r, '' ORDER BY region_no) || '</Page></PcGts>' AS content FROM l GROUP BY doc_id""",
    "violations": "SELECT doc_id, '' AS rule, 0 AS node_id, '' AS detail FROM doclang_docs WHERE FALSE",
    "node_text": _TEXTS + " SELECT doc_id, text FROM e",
    "four_locations": _TEXTS + _BOXES,
    "pairs_union": _TEXTS + f", b AS ({_BOXES}) SELECT 1 AS rank, * FROM b UNION ALL SELECT 0, doc_id, regexp_replace(l.text, '^{_BLANKS}+|{_BLANKS}+$', '', 'g'), least(l.bbox.x1, l.bbox.x2), least(l.bbox.y1, l.bbox.y2), greatest(l.bbox.x1, l.bbox.x2), greatest(l.bbox.y1, l.bbox.y2) FROM (SELECT doc_id, unnest(lines) AS l FROM {_R}) WHERE l.bbox.x1 IS NOT NULL AND regexp_matches(l.text, '[^\\s\\x{{0b}}\\x{{1c}}-\\x{{1f}}\\x{{85}}\\pZ]')",
    "zones": f"""WITH r AS (SELECT doc_id, count(*) AS n, sum(len(lines)) AS k FROM {_R} GROUP BY doc_id)
SELECT doc_id, z AS zone, CASE WHEN z < n THEN 'TextRegion' ELSE 'TextLine' END AS tag FROM (SELECT doc_id, n, CAST(unnest(range(CAST(n + coalesce(k, 0) AS BIGINT))) AS INTEGER) AS z FROM r)""",
    "page_shred": f"""WITH r AS (SELECT DISTINCT doc_id, region_no, region_id, bbox, lines FROM regions), l AS (SELECT unnest(lines) AS l FROM r)
SELECT unnest(['PcGts', 'Metadata', 'Page']) AS tag, (SELECT count(DISTINCT doc_id) FROM r) AS nodes UNION ALL SELECT 'TextRegion', count(*) FROM r UNION ALL SELECT 'Coords', (SELECT count(*) FROM r WHERE bbox.x1 IS NOT NULL) + (SELECT count(*) FROM l WHERE l.bbox.x1 IS NOT NULL)
UNION ALL SELECT unnest(['TextLine', 'TextEquiv', 'Unicode']), (SELECT count(*) FROM l) UNION ALL SELECT '#text', count(*) FROM l WHERE coalesce(l.text, '') <> ''""",
    "doclang_shred": f"""SELECT type AS tag, count(*) AS nodes FROM {_TYPED} WHERE type IS NOT NULL AND type NOT IN ('text_chunk', 'content') GROUP BY type UNION ALL SELECT 'doclang', count(*) FROM {_RENDERED} UNION ALL SELECT 'head', count(*) FROM {_RENDERED} WHERE head NOT IN ('', 'null')""",
    "line_coords": "SELECT doc_id, region_id, l.line_id AS line_id, b.x1 || ',' || b.y1 || ' ' || b.x2 || ',' || b.y1 || ' ' || b.x2 || ',' || b.y2 || ' ' || b.x1 || ',' || b.y2 AS points FROM (SELECT doc_id, region_id, l, l.bbox AS b FROM (SELECT doc_id, region_id, unnest(lines) AS l FROM (SELECT DISTINCT doc_id, region_no, region_id, lines FROM regions))) WHERE b.x1 IS NOT NULL",
    "baseline_coords": "SELECT doc_id, l.line_id AS line_id, CAST(2 AS BIGINT) AS n, greatest(l.bbox.y1, l.bbox.y2) AS y FROM (SELECT doc_id, unnest(lines) AS l FROM (SELECT DISTINCT doc_id, region_no, region_id, lines FROM regions)) WHERE l.bbox.x1 IS NOT NULL",
    "class_coords": f"SELECT doc_id, region_id, {_CLASS} AS class_id, CAST(4 AS BIGINT) AS n_points FROM (SELECT DISTINCT doc_id, region_no, region_id, bbox FROM regions) WHERE bbox.x1 IS NOT NULL",
    "declared_size": f"""SELECT DISTINCT doc_id, max(page_w) OVER (PARTITION BY doc_id) AS width, max(page_h) OVER (PARTITION BY doc_id) AS height FROM regions
UNION ALL SELECT doc_id, CAST(w AS INTEGER), CAST(h AS INTEGER) FROM (SELECT doc_id, arg_min(json_extract_string(j.value, '$.width'), j.id) AS w, arg_min(json_extract_string(j.value, '$.height'), j.id) AS h
  FROM {_RENDERED} d, json_each(d.head, '$.items') j WHERE d.head <> '' AND json_extract_string(j.value, '$.type') = 'default_resolution' AND json_extract_string(j.value, '$.width') IS NOT NULL AND json_extract_string(j.value, '$.height') IS NOT NULL GROUP BY doc_id)""",
    "page_round_trip": f"SELECT doc_id, region_id, l.line_id AS line_id, coalesce(l.text, '') AS text FROM (SELECT doc_id, region_id, unnest(lines) AS l FROM {_R})",
    "lines_with_coords": f"SELECT doc_id, region_id, l.line_id AS line_id, least(l.bbox.x1, l.bbox.x2) AS x1, least(l.bbox.y1, l.bbox.y2) AS y1, greatest(l.bbox.x1, l.bbox.x2) AS x2, greatest(l.bbox.y1, l.bbox.y2) AS y2 FROM (SELECT doc_id, region_id, unnest(lines) AS l FROM {_R}) WHERE l.bbox.x1 IS NOT NULL",
}
