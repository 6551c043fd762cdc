"""Pages, their images and their transcription."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundset.functions.text import strip

PROMPT = "Transcribe the text in this document."


def first_image(images: DataFrame) -> DataFrame:
    """(stem, path): of several images of a page the one with the first extension."""
    return images.where("stem IS NOT NULL").groupBy("stem").agg(F.min_by("path", F.struct("ext", "path")).alias("path"))


def reading_order(custom: Column) -> Column:
    """The index in "readingOrder {index:N;}"; the last one counts, null if there is none."""
    return F.nullif(F.regexp_extract(F.coalesce(custom, F.lit("")), r"(?s)^.*readingOrder \{index:(\d+);.*\}", 1), F.lit("")).cast("int")


def region_type(custom: Column) -> Column:
    """The type in "structure {type:T;}", up to its semicolon."""
    return F.nullif(F.regexp_extract(F.coalesce(custom, F.lit("")), r"structure \{[^}]*type:([^;}]*);", 1), F.lit(""))


def nonblank(lines: DataFrame, text: str) -> DataFrame:
    """Rows whose text has something to read, stripped."""
    return lines.withColumn(text, strip(F.col(text))).where(F.length(text) > 0)


def transcription(regions: DataFrame) -> DataFrame:
    """(doc_id, text): the lines of a page by reading order, null ones last, then by their place; blank lines left out."""
    line = regions.select("doc_id", "region_no", F.posexplode("lines").alias("k", "l")).select("doc_id", F.struct(F.col("l.reading_order").isNull().alias("none"), F.col("l.reading_order").alias("ro"), "region_no", "k").alias("at"), strip(F.col("l.text")).alias("text"))
    line = line.where(F.length("text") > 0)
    page = line.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("at", "text"))).alias("ls"))
    return page.select("doc_id", F.array_join(F.transform("ls", lambda x: x["text"]), "\n").alias("text"))


def page_transcription(lines: DataFrame) -> DataFrame:
    """(doc_id, text) of the lines of shredded page files (doc_id, line_no, custom, text), in the order of ``transcription``."""
    line = lines.select("doc_id", F.struct(reading_order(F.col("custom")).isNull().alias("none"), reading_order(F.col("custom")).alias("ro"), "line_no").alias("at"), strip(F.col("text")).alias("text")).where(F.length("text") > 0)
    page = line.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("at", "text"))).alias("ls"))
    return page.select("doc_id", F.array_join(F.transform("ls", lambda x: x["text"]), "\n").alias("text"))


def skip_reasons(docs: DataFrame, regions: DataFrame, images: DataFrame) -> DataFrame:
    """(doc_id, skip_reason): the first check a page fails; null if it passes all."""
    usable = regions.where(F.exists("lines", lambda x: F.length(strip(F.coalesce(x["text"], F.lit("")))) > 0)).select("doc_id").distinct().withColumn("has_text", F.lit(True))
    pics = first_image(images).withColumnRenamed("stem", "doc_id")
    out = docs.join(usable, "doc_id", "left").join(pics, "doc_id", "left")
    return out.select("doc_id", F.when(F.col("has_text").isNull(), "no text").when(F.col("path").isNull(), "no image").alias("skip_reason"))


def transcription_records(regions: DataFrame, images: DataFrame) -> DataFrame:
    """(doc_id, prompt, completion, path): pages with text and an image."""
    pics = first_image(images).withColumnRenamed("stem", "doc_id")
    return transcription(regions).join(pics, "doc_id").select("doc_id", F.lit(PROMPT).alias("prompt"), F.col("text").alias("completion"), "path")
