"""Queries of the builder and of the inventories, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundset.operators import build, inventory, markup
from groundset.plans import markup as P
from groundset.plans.records import _PIC
from groundset.plans.tasks import _box
from groundset.session import table


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page files and markup documents as a scan of folders gives them: doc_id, stem, suffix, rank, content."""
    pages = P.page_write(spark, sf_dir).select(F.concat("doc_id", F.lit(".xml")).alias("doc_id"), F.col("doc_id").alias("stem"), F.lit(".xml").alias("suffix"), F.lit(0).alias("rank"), "content")
    docs = P.doclang_serialize(spark, sf_dir).select(F.concat("doc_id", F.lit(".dclg")).alias("doc_id"), F.col("doc_id").alias("stem"), F.lit(".dclg").alias("suffix"), F.lit(1).alias("rank"), "content")
    return pages.unionByName(docs)


def doc_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files, page files first, each kind by its path."""
    return _files(spark, sf_dir).select("rank", "doc_id").orderBy("rank", "doc_id")


def _built(spark: SparkSession, sf_dir: str, mode: str, fmt: str = "qwen", **kw) -> build.Built:
    files = _files(spark, sf_dir).where(F.col("suffix").isin(*build.SUFFIXES[mode in build.FLAT_MODES]))
    return build.build(files, table(spark, sf_dir, "images"), mode, fmt, **kw)


def build_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _built(spark, sf_dir, "bbox_to_text").candidates.select("doc_id", "prompt", "completion", "path")


def build_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _built(spark, sf_dir, "region_to_lines", "doclang").candidates.select("doc_id", "prompt", "completion", "path")


def build_skips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _built(spark, sf_dir, "line_count").skips.groupBy("reason").agg(F.count("*").alias("files"))


def build_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of one mode, their blocks as text."""
    said = lambda c: F.array_join(F.transform(F.flatten(F.transform(c, lambda m: m["content"])), lambda b: F.concat_ws("=", b["type"], b["text"])), "+")
    r = _built(spark, sf_dir, "line_count").records
    return r.select(said("prompt").alias("prompt"), said("completion").alias("completion"), F.array_join(F.transform("images", lambda i: i["path"]), ",").alias("images"))


def build_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of all candidates: how many, and how many are none of them."""
    b = _built(spark, sf_dir, "line_index", max_lines=300)
    all_ = _built(spark, sf_dir, "line_index").candidates
    keys = ["doc_id", "region_no", "prompt", "completion"]
    other = b.candidates.join(all_, keys, "left_anti").agg(F.count("*").alias("other"))
    return b.candidates.agg(F.count("*").alias("drawn")).crossJoin(F.broadcast(other))  # one row each


def inventories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.inventories(spark)


def inventory_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one of the four forms of the vocabulary has and another lacks; and, as a fifth, what the documents use."""
    used = P._nodes(spark, sf_dir).where("tag <> '#text'").select(F.lit("documents").alias("source"), F.lit("element").alias("kind"), F.col("tag").alias("item")).distinct()
    return inventory.differences(inventory.inventories(spark).where("kind = 'element'").unionByName(used))


def root_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.inferred_root(inventory.child_edges(spark))


QUERIES = {
    "doc_scan": doc_scan, "build_flat": build_flat, "build_region": build_region, "build_skips": build_skips, "build_records": build_records, "build_sample": build_sample, "inventories": inventories, "inventory_diff": inventory_diff, "root_element": root_element,
}

_R = "(SELECT DISTINCT doc_id, region_no, region_id, page_w, page_h, bbox, lines FROM regions)"
_OK = "x.text IS NOT NULL AND length(regexp_replace(x.text, '^[\\s\\x{0b}\\x{1c}-\\x{1f}\\x{85}\\pZ]+|[\\s\\x{0b}\\x{1c}-\\x{1f}\\x{85}\\pZ]+$', '', 'g')) > 0 AND x.bbox IS NOT NULL AND x.bbox.x1 IS NOT NULL"
_NORM = "{'x1': least(x.bbox.x1, x.bbox.x2), 'y1': least(x.bbox.y1, x.bbox.y2), 'x2': greatest(x.bbox.x1, x.bbox.x2), 'y2': greatest(x.bbox.y1, x.bbox.y2)}"
_BASE = f"""WITH pg AS (SELECT doc_id, max(page_w) AS w, max(page_h) AS h FROM regions GROUP BY doc_id),
r AS (SELECT doc_id, region_no, {{'x1': least(bbox.x1, bbox.x2), 'y1': least(bbox.y1, bbox.y2), 'x2': greatest(bbox.x1, bbox.x2), 'y2': greatest(bbox.y1, bbox.y2)}} AS b, bbox,
  list_transform(list_filter(lines, lambda x: {_OK}), lambda x: {{'text': regexp_replace(x.text, '^[\\s\\x{{0b}}\\x{{1c}}-\\x{{1f}}\\x{{85}}\\pZ]+|[\\s\\x{{0b}}\\x{{1c}}-\\x{{1f}}\\x{{85}}\\pZ]+$', '', 'g'), 'bbox': {_NORM}}}) AS ls FROM {_R}),
p AS (SELECT r.*, pg.w, pg.h, i.path FROM r JOIN pg ON pg.doc_id = r.doc_id JOIN {_PIC} i ON i.doc_id = r.doc_id)"""
_USED = "SELECT doc_id FROM r WHERE len(ls) > 0 AND bbox.x1 IS NOT NULL"
_ITEMS = "(VALUES " + ", ".join(f"('{k}', '{i}')" for k, i in sorted(inventory.rules_inventory())) + ") AS v(kind, item)"
ORACLE = {
    "doc_scan": f"SELECT 0 AS rank, doc_id || '.xml' AS doc_id FROM (SELECT DISTINCT doc_id FROM regions WHERE region_no IS NOT NULL AND region_id IS NOT NULL) UNION ALL SELECT 1, doc_id || '.dclg' FROM {P._RENDERED}",
    "build_flat": _BASE + f" SELECT doc_id || '.xml' AS doc_id, 'Transcribe the text inside the bounding box ' || {_box('x.bbox', 'qwen')} || '. All bounding-box coordinates are integers normalized to the 0-1000 range.' AS prompt, x.text AS completion, path FROM (SELECT doc_id, w, h, path, unnest(ls) AS x FROM p)",
    "build_region": _BASE + f" SELECT doc_id || '.xml' AS doc_id, 'List the bounding boxes of all text lines in the paragraph ' || {_box('b', 'doclang')} || ', in reading order.' AS prompt, '[' || array_to_string(list_transform(ls, lambda y: {_box('y.bbox', 'doclang', True)}), ', ') || ']' AS completion, path FROM p WHERE len(ls) >= 2 AND bbox.x1 IS NOT NULL",
    "build_skips": _BASE + f" SELECT CASE WHEN u.doc_id IS NULL THEN '{build.UNUSABLE}' ELSE '{build.NO_IMAGE}' END AS reason, count(*) AS files FROM pg LEFT JOIN (SELECT DISTINCT doc_id FROM ({_USED})) u ON u.doc_id = pg.doc_id LEFT JOIN {_PIC} i ON i.doc_id = pg.doc_id WHERE u.doc_id IS NULL OR i.doc_id IS NULL GROUP BY 1",
    "build_records": _BASE + f" SELECT 'image+text=How many text lines are in the paragraph ' || {_box('b', 'qwen')} || '? All bounding-box coordinates are integers normalized to the 0-1000 range.' AS prompt, 'text=' || CAST(len(ls) AS VARCHAR) AS completion, path AS images FROM p WHERE len(ls) >= 1 AND bbox.x1 IS NOT NULL",
    "build_sample": _BASE + " SELECT least(300, CAST(sum(CASE WHEN len(ls) >= 2 AND bbox.x1 IS NOT NULL THEN 2 * len(ls) ELSE 0 END) AS BIGINT)) AS drawn, CAST(0 AS BIGINT) AS other FROM p",
    "inventories": f"SELECT s.source, v.kind, v.item FROM {_ITEMS}, (VALUES ('rules'), ('renderer'), ('schema'), ('grammar')) AS s(source)",
    "inventory_diff": P.USED_TAGS + f""", w AS (SELECT unnest([{", ".join(repr(t) for t in markup.VOCABULARY)}]) AS tag), forms AS (SELECT unnest(['rules', 'renderer', 'schema', 'grammar']) AS f)
SELECT 'documents' AS one, f AS other, 'element' AS kind, tag AS item FROM forms, (SELECT DISTINCT tag FROM u WHERE tag NOT IN (SELECT tag FROM w)) UNION ALL SELECT f, 'documents', 'element', tag FROM forms, (SELECT tag FROM w WHERE tag NOT IN (SELECT tag FROM u))""",
    "root_element": "SELECT 'doclang' AS root",
}
