"""Chat rows from JSON lines, whose content may be a string or a list of blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundset.functions.text import strip

BLOCK = "array<struct<type:string,text:string,image:string>>"


def _is(v: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith(kind), F.lit(False))


def _content(v: Column) -> Column:
    """One list of blocks for either form of content."""
    text = F.array(F.struct(F.lit("text").alias("type"), F.try_variant_get(v, "$", "string").alias("text"), F.lit(None).cast("string").alias("image")))
    return F.when(_is(v, "STRING"), text).when(_is(v, "ARRAY"), F.try_variant_get(v, "$", BLOCK))


def parse_line(text: Column) -> Column:
    """One JSON value a line, as a variant; null if the line holds none, more than one or anything behind it.

    The parser stops after the first value, so the line is parsed as the one element of an array.
    """
    w = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    return F.when(F.try_variant_get(w, "$[1]", "variant").isNull(), F.try_variant_get(w, "$[0]", "variant"))


def typed_rows(raw: DataFrame, text: str = "raw") -> DataFrame:
    """Columns image, prompt, messages, completion, chosen, rejected, label and defect of lines of JSON.

    A line that isn't a JSON object has defect 'malformed'. A label counts only if it is a
    JSON boolean: 1 and "yes" don't.
    """
    v = parse_line(F.col(text))
    r = raw.withColumn("_v", v)
    ok = _is(F.col("_v"), "OBJECT")
    get = lambda k: F.when(ok, F.try_variant_get("_v", f"$.{k}", "string"))
    history = F.when(ok, F.try_variant_get("_v", "$.messages", "array<struct<role:string,content:variant>>"))
    messages = F.transform(history, lambda m: F.struct(m["role"].alias("role"), _content(m["content"]).alias("content")))
    label = F.when(ok, F.try_variant_get("_v", "$.label", "variant"))
    return r.select(
        *[c for c in raw.columns],
        get("image").alias("image"),
        get("prompt").alias("prompt"),
        messages.alias("messages"),
        get("completion").alias("completion"),
        get("chosen").alias("chosen"),
        get("rejected").alias("rejected"),
        F.when(_is(label, "BOOLEAN"), F.try_variant_get(label, "$", "boolean")).alias("label"),
        F.when(~ok, "malformed").alias("defect"),
    )


def scan_jsonl(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Lines of JSON: raw text and parsed value, blank lines left out. A broken line has a null value, or is an error in strict mode."""
    raw = spark.read.text(path).select(strip(F.col("value")).alias("raw")).where(F.length("raw") > 0)
    v = parse_line(F.col("raw"))
    return raw.withColumn("v", F.when(v.isNull(), F.raise_error(F.concat(F.lit("broken line: "), F.col("raw"))).cast("variant")).otherwise(v) if strict else v)
