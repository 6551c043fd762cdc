"""Jobs from the command line: ``python -m groundset MODE --input FOLDER --images FOLDER --output FOLDER``."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from groundset.functions.geometry import FORMATS
from groundset.operators import build, markup, pages, tasks
from groundset.session import get_spark, ship
from groundset.sources import images, xml


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="groundset", description="Training records from page files, markup documents and images.")
    p.add_argument("mode", choices=[*tasks.MODES, "transcription", "markup"])
    for name in ("input", "images", "output"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--box-format", choices=FORMATS, default="qwen")
    p.add_argument("--max-lines", type=int)
    p.add_argument("--max-n", type=int, default=3)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--master")
    return p


def main(argv: list[str] | None = None) -> dict[str, int]:
    """Runs one job and returns how many records it wrote and files it skipped."""
    p = parser()
    args = p.parse_args(argv)
    if args.max_n < 1 or (args.max_lines is not None and args.max_lines < 1):
        p.error("--max-lines and --max-n must be at least 1")
    spark = get_spark(args.master or "local[*]")
    ship(spark)
    if args.mode in tasks.MODES:
        built = build.build_folder(spark, args.input, args.images, args.mode, args.box_format, args.max_lines, args.seed, args.max_n)
        records, skipped = built.records, built.skips.count()
    else:
        found = pages.first_image(images.find(spark, args.images, recursive=False)).withColumnRenamed("stem", "doc_id")
        docs = xml.scan_documents(spark, args.input, (".xml",) if args.mode == "transcription" else (".dclg",)).select(F.col("stem").alias("doc_id"), "content")
        nodes = xml.shred(docs, "doc_id", "content", xml.ROOTS)
        if args.mode == "transcription":
            said = pages.page_transcription(xml.page_lines(nodes))
        else:
            said = markup.valid_documents(docs, markup.violations(nodes)).select("doc_id", pages.strip(F.col("content")).alias("text"))
        prompt = pages.PROMPT if args.mode == "transcription" else markup.PROMPT
        kept = said.join(found, "doc_id").select("doc_id", F.lit(prompt).alias("prompt"), F.col("text").alias("completion"), "path")
        records, skipped = tasks.as_records(kept), docs.count() - kept.count()
    records.write.mode("overwrite").parquet(args.output)
    done = {"records": spark.read.parquet(args.output).count(), "skipped": skipped}
    print(done)
    return done


if __name__ == "__main__":
    main()
