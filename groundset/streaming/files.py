"""The converters as Structured Streaming queries over folders that grow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundset.functions.text import strip
from groundset.operators.preference import convert
from groundset.operators.sampling import draw
from groundset.sources.jsonl import typed_rows
from groundset.sources.xml import shred


def read_lines(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path).select(strip(F.col("value")).alias("raw")).where(F.length("raw") > 0)


def stream_records(spark: SparkSession, path: str, method: str) -> DataFrame:
    """Records of one method from JSON lines as they arrive; no state is kept."""
    return convert(typed_rows(read_lines(spark, path)).where("defect IS NULL"), method)


def stream_nodes(spark: SparkSession, path: str, suffix: str = ".xml") -> DataFrame:
    """Node tables of documents as they arrive, one file a document."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", f"*{suffix}").load(path)
    return shred(files.select("path", F.decode("content", "UTF-8").alias("text")), "path", "text")


def stream_sample(records: DataFrame, keys: list[str], n: int, target: str, seed: int = 42):
    """Keep the n rows of smallest digest over all batches in a table at ``target``: every batch merges into the last one."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = batch.withColumn("_draw", draw(seed, *keys))
        if number:
            new = new.unionByName(spark.read.parquet(f"{target}/{number - 1}"))
        new.orderBy("_draw", *keys).limit(n).write.mode("overwrite").parquet(f"{target}/{number}")

    return records.writeStream.foreachBatch(merge)


def event_windows(events: DataFrame, ts: str, length: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts of events by window and type; on a stream, rows later than ``late`` are dropped by the watermark."""
    e = events.withColumn("_ts", F.col(ts).cast("timestamp"))
    if e.isStreaming:
        e = e.withWatermark("_ts", late)
    w = e.groupBy(F.window("_ts", length).alias("w"), "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("total"))
    return w.select(F.col("w.start").alias("start"), "event_type", "events", "total")
