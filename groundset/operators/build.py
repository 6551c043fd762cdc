"""Training records from a folder of page files, markup documents and images.

Files are shredded once. A file is skipped at its first failing check (it can't be parsed, it
holds nothing to use, it has no image); what is left becomes prompts and answers, a sample of
them if a most is given, and records.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundset.functions import geometry as G
from groundset.functions.text import strip
from groundset.operators import markup, sampling, tasks
from groundset.operators.pages import first_image
from groundset.session import written
from groundset.sources import images as I
from groundset.sources import xml

FLAT_MODES = ("bbox_to_text", "text_to_bbox")
SUFFIXES = {True: (".xml", ".dclg"), False: (".xml",)}  # of line modes, and of region modes, as markup has no lines
UNREADABLE, UNUSABLE, NO_IMAGE = "could not parse", "nothing usable", "no source image"
LINE = f"struct<idx:int,line_id:string,reading_order:int,text:string,bbox:{G.BOX}>"


@dataclass
class Built:
    """candidates: doc_id, region_no, prompt, completion, path; skips: doc_id, reason; records: prompt, completion, images."""

    candidates: DataFrame
    skips: DataFrame
    records: DataFrame


def _line(at: Column, text: Column, box: Column) -> Column:
    return F.struct(at.cast("int").alias("idx"), F.lit(None).cast("string").alias("line_id"), F.lit(None).cast("int").alias("reading_order"), text.alias("text"), box.alias("bbox"))


def region_rows(nodes: DataFrame) -> DataFrame:
    """(doc_id, region_no, bbox, lines) of the regions of page files whose points can be read.

    A line belongs to every region around it, so those of a nested region stand in both; lines
    without text or without points are left out, and so are regions left with none.
    """
    region = nodes.where("tag = 'TextRegion'").select("doc_id", "node_id", "subtree_end")
    points = nodes.where("tag = 'Coords' AND parent_tag = 'TextRegion'").groupBy("doc_id", F.col("parent_id").alias("node_id")).agg(F.min_by(F.col("attrs")["points"], "node_id").alias("points"))
    region = region.join(points, ["doc_id", "node_id"]).withColumn("bbox", G.hull(G.parse_points(F.col("points")))).where("bbox IS NOT NULL")
    line = xml.lines_with_coords(xml.page_lines(nodes)).withColumn("text", strip(F.coalesce("text", F.lit("")))).where(F.length("text") > 0).select("doc_id", "line_no", "text", F.col("bbox").alias("lb"))
    inside = region.join(line, "doc_id").where("line_no > node_id AND line_no <= subtree_end")
    return inside.groupBy("doc_id", F.col("node_id").alias("region_no")).agg(F.first("bbox").alias("bbox"), F.array_sort(F.collect_list(_line(F.col("line_no"), F.col("text"), F.col("lb")))).alias("lines"))


def flat_rows(nodes: DataFrame) -> DataFrame:
    """(doc_id, region_no, bbox, lines) with all lines of a page file, also those outside regions, or all boxed texts of a markup document, as one region."""
    page = xml.lines_with_coords(xml.page_lines(nodes)).withColumn("text", strip(F.coalesce("text", F.lit("")))).where(F.length("text") > 0).select("doc_id", F.col("line_no").alias("at"), "text", "bbox")
    doc = markup.text_pairs(nodes).select("doc_id", F.col("node_id").alias("at"), "text", "bbox")
    return page.unionByName(doc).groupBy("doc_id").agg(F.lit(0).alias("region_no"), F.first("bbox").alias("bbox"), F.array_sort(F.collect_list(_line(F.col("at"), F.col("text"), F.col("bbox")))).alias("lines"))


def build(files: DataFrame, images: DataFrame, mode: str, fmt: str, max_lines: int | None = None, seed: int = 42, max_n: int = 3) -> Built:
    """Everything of one mode in one box format.

    files: doc_id (unique), stem, content; images: stem, ext, path, width, height, the size as
    its header has it. The size of a page is the declared one, else the image's. With
    ``max_lines`` a larger pool is sampled as a whole, without replacement. A document with
    two images takes that of the first extension.
    """
    if mode not in tasks.MODES:
        raise ValueError(f"unknown mode: {mode}")
    if max_lines is not None and max_lines < 1:
        raise ValueError("max_lines must be at least 1")
    nodes = written(xml.shred(files, "doc_id", "content", xml.ROOTS), "nodes")
    bad = nodes.where("error IS NOT NULL").select("doc_id", "error").unionByName(markup.rejected(nodes))
    rows = (flat_rows if mode in FLAT_MODES else region_rows)(nodes)
    used = rows.select("doc_id").distinct().withColumn("used", F.lit(True))
    first = first_image(images).join(images.select("path", F.col("width").alias("iw"), F.col("height").alias("ih")), "path")
    state = files.select("doc_id", "stem").join(bad, "doc_id", "left").join(used, "doc_id", "left").join(first, "stem", "left")
    reason = F.when(F.col("error").isNotNull(), UNREADABLE).when(F.col("used").isNull(), UNUSABLE).when(F.col("path").isNull(), NO_IMAGE)
    state = state.withColumn("reason", reason)
    size = xml.declared_size(nodes)
    kept = state.where("reason IS NULL").join(size, "doc_id", "left").select("doc_id", "path", F.coalesce("width", "iw").alias("page_w"), F.coalesce("height", "ih").alias("page_h"))
    whole = tasks.build(rows.join(kept, "doc_id"), mode, fmt, **({"max_n": max_n} if mode == "line_neighbor" else {}), seed=seed)
    candidates = whole.join(kept.select("doc_id", "path"), "doc_id")
    if max_lines is not None:
        candidates = sampling.sample_global(candidates, ["doc_id", "region_no", "prompt", "completion"], max_lines, seed)
    return Built(candidates, state.where("reason IS NOT NULL").select("doc_id", "reason"), tasks.as_records(candidates))


def build_folder(spark: SparkSession, folder: str, image_folder: str, mode: str, fmt: str, max_lines: int | None = None, seed: int = 42, max_n: int = 3) -> Built:
    """``build`` over the files of two folders; sizes are read from the headers of images."""
    docs = xml.scan_documents(spark, folder, SUFFIXES[mode in FLAT_MODES]).select(F.col("path").alias("doc_id"), "stem", "content")
    return build(docs, I.sizes(I.find(spark, image_folder, recursive=False)), mode, fmt, max_lines, seed, max_n)
