"""Queries of problem 2: nested records as flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundset.operators.nested import array_nodes, inside, json_nodes, tables_by_type
from groundset.session import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per element or line with its parent; deliveries of a document count once."""
    one = json_nodes(table(spark, sf_dir, "doclang_docs"), F.col("doc_id"), ["head", "body"]).select(F.col("rid").alias("doc_id"), "node_key", "parent_key")
    two = array_nodes(table(spark, sf_dir, "regions"), "doc_id", "region_id", "lines", "idx").select("doc_id", "node_key", "parent_key")
    return one.unionByName(two).distinct()


def p2_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The node table of every delivery with its interval labels."""
    return json_nodes(table(spark, sf_dir, "doclang_docs"), F.col("record_id"), ["head", "body"]).select(F.col("rid").cast("long").alias("record_id"), "part", "node_key", "parent_key", "type", "pre", "post", "depth")


def p2_texts_in_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text runs inside each table element at any depth, linked by interval containment."""
    nodes = json_nodes(table(spark, sf_dir, "doclang_docs"), F.col("record_id"), ["body"])
    by = tables_by_type(nodes, ["table", "text_chunk"])
    return inside(by["table"], by["text_chunk"]).groupBy(F.col("rid").cast("long").alias("record_id"), "outer_key").agg(F.count("*").alias("runs"))


_KEY = "regexp_replace(regexp_replace(j.fullkey, '^\\$', ''), '\\[(\\d+)\\]', '.\\1', 'g')"
_NODES = f"""
WITH parts AS (
  SELECT record_id, doc_id, 'head' AS part, head AS js FROM doclang_docs WHERE head IS NOT NULL AND json_valid(head)
  UNION ALL SELECT record_id, doc_id, 'body', body FROM doclang_docs WHERE body IS NOT NULL AND json_valid(body)),
tree AS (
  SELECT p.record_id, p.doc_id, p.part, p.part || {_KEY} AS node_key, json_extract_string(j.value, '$.type') AS type, j.id AS id, j.type AS jt
  FROM parts p, json_tree(p.js) j),
elements AS (SELECT * FROM tree WHERE jt = 'OBJECT' AND type IS NOT NULL)"""
_PARENT = "coalesce((SELECT max_by(a.node_key, length(a.node_key)) FROM elements a WHERE a.record_id = e.record_id AND a.part = e.part AND starts_with(e.node_key, a.node_key || '.')), '')"

QUERIES = {"p2_found": p2_found, "p2_nodes": p2_nodes, "p2_texts_in_tables": p2_texts_in_tables}
ORACLE = {
    "p2_found": f"""{_NODES}
SELECT DISTINCT e.doc_id, e.node_key, {_PARENT} AS parent_key FROM elements e
UNION SELECT doc_id, region_id, '' FROM regions
UNION SELECT doc_id, region_id || '.' || CAST(l.idx AS VARCHAR), region_id FROM (SELECT doc_id, region_id, unnest(lines) AS l FROM regions)""",
    "p2_nodes": f"""{_NODES},
ranked AS (SELECT e.record_id, e.part, e.node_key, e.type, e.id, row_number() OVER (PARTITION BY e.record_id, e.part ORDER BY e.id) - 1 AS k FROM elements e),
inner_ AS (SELECT a.record_id, a.part, a.node_key, count(b.node_key) AS below FROM elements a LEFT JOIN elements b ON b.record_id = a.record_id AND b.part = a.part AND starts_with(b.node_key, a.node_key || '.') GROUP BY ALL),
outer_ AS (SELECT a.record_id, a.part, a.node_key, count(b.node_key) AS depth, coalesce(max_by(b.node_key, length(b.node_key)), '') AS parent_key FROM elements a LEFT JOIN elements b ON b.record_id = a.record_id AND b.part = a.part AND starts_with(a.node_key, b.node_key || '.') GROUP BY ALL)
SELECT r.record_id, r.part, r.node_key, o.parent_key, r.type, CAST(2 * r.k - o.depth AS INTEGER) AS pre, CAST(2 * r.k - o.depth + 2 * i.below + 1 AS INTEGER) AS post, CAST(o.depth AS INTEGER) AS depth
FROM ranked r JOIN inner_ i ON i.record_id = r.record_id AND i.part = r.part AND i.node_key = r.node_key JOIN outer_ o ON o.record_id = r.record_id AND o.part = r.part AND o.node_key = r.node_key""",
    "p2_texts_in_tables": f"""{_NODES}
SELECT t.record_id, t.node_key AS outer_key, count(*) AS runs FROM elements t JOIN elements c
ON c.record_id = t.record_id AND c.part = t.part AND starts_with(c.node_key, t.node_key || '.')
WHERE t.type = 'table' AND c.type = 'text_chunk' AND t.part = 'body' GROUP BY ALL""",
}
