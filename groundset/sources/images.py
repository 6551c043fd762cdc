"""Image files: lookup by stem and sizes from their headers, read without an image library."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Extensions that count as images, in the order in which one of several is taken.
EXTENSIONS = (".bmp", ".gif", ".jpeg", ".jpg", ".png", ".tif", ".tiff", ".webp")
HEADER_BYTES = 1 << 18  # within which the sizes of pictures stand, long comments in front of them included
_NO_SIZE = {0xC4, 0xC8, 0xCC}


def header_size(b: bytes) -> tuple[int, int] | None:
    """(width, height) from the first bytes of a picture; None if they can't be read."""
    try:
        if b[:8] == b"\x89PNG\r\n\x1a\n":
            return struct.unpack(">II", b[16:24])
        if b[:6] in (b"GIF87a", b"GIF89a"):
            return struct.unpack("<HH", b[6:10])
        if b[:2] == b"BM":
            w, h = struct.unpack("<ii", b[18:26])
            return w, abs(h)
        if b[:2] == b"\xff\xd8":
            i = 2
            while i + 9 < len(b):
                if b[i] != 0xFF:
                    return None
                kind = b[i + 1]
                if 0xC0 <= kind <= 0xCF and kind not in _NO_SIZE:
                    h, w = struct.unpack(">HH", b[i + 5 : i + 9])
                    return w, h
                i += 2 + struct.unpack(">H", b[i + 2 : i + 4])[0]
            return None
        if b[:4] in (b"II*\0", b"MM\0*"):
            e = "<" if b[:2] == b"II" else ">"
            at = struct.unpack(e + "I", b[4:8])[0]
            got: dict[int, int] = {}
            for k in range(struct.unpack(e + "H", b[at : at + 2])[0]):
                tag, kind = struct.unpack(e + "HH", b[at + 2 + 12 * k : at + 6 + 12 * k])
                raw = b[at + 10 + 12 * k : at + 14 + 12 * k]
                if tag in (256, 257):
                    got[tag] = struct.unpack(e + ("H" if kind == 3 else "I"), raw[: 2 if kind == 3 else 4])[0]
            return (got[256], got[257]) if len(got) == 2 else None
        if b[:4] == b"RIFF" and b[8:12] == b"WEBP":
            if b[12:16] == b"VP8X":
                return 1 + int.from_bytes(b[24:27], "little"), 1 + int.from_bytes(b[27:30], "little")
            if b[12:16] == b"VP8 ":
                w, h = struct.unpack("<HH", b[26:30])
                return w & 0x3FFF, h & 0x3FFF
            if b[12:16] == b"VP8L":
                n = int.from_bytes(b[21:25], "little")
                return 1 + (n & 0x3FFF), 1 + (n >> 14 & 0x3FFF)
    except (struct.error, KeyError, IndexError):
        pass
    return None


def first_bytes(path: str, n: int = HEADER_BYTES) -> bytes | None:
    """The first bytes of a file on any file system pyarrow knows; None if it can't be read."""
    from pyarrow import fs

    try:
        local = re.match(r"file:/(?!/)", path)
        system, at = fs.FileSystem.from_uri(f"file://{path[5:]}" if local else path if "://" in path else f"file://{path}")
        with system.open_input_file(at) as f:
            return f.read(n)
    except (OSError, ValueError):
        return None


def sizes(files: DataFrame) -> DataFrame:
    """All columns with width and height of the pictures under ``path``; null where the header can't be read. Only first bytes are read."""
    keep = [c for c in files.columns if c not in ("width", "height", "content")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [(header_size(c) if (c := p and first_bytes(p)) else None) or (None, None) for p in b.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array([g[0] for g in got], pa.int32()), pa.array([g[1] for g in got], pa.int32())], [*keep, "width", "height"])

    return files.select(*keep).mapInArrow(run, T.StructType([*(files.schema[c] for c in keep), T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]))


def find(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """(path, stem, ext) of image files, any case of the extension. Contents aren't read."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path).select("path")
    ext = F.lower(F.regexp_extract("path", r"(\.[A-Za-z0-9]+)$", 1))
    return f.select("path", F.regexp_extract("path", r"([^/]+?)(\.[^./]+)?$", 1).alias("stem"), ext.alias("ext")).where(F.col("ext").isin(*EXTENSIONS))


def with_size(docs: DataFrame, files: DataFrame) -> DataFrame:
    """docs (doc_id, width, height, path) with the picture's own size where none is declared; only those pictures are read."""
    without = docs.where("width IS NULL OR height IS NULL").select("path")
    read = sizes(files.select("path").join(without, "path", "left_semi")).withColumnsRenamed({"width": "w", "height": "h"})
    out = docs.join(read, "path", "left")
    none = F.col("width").isNull() | F.col("height").isNull()
    return out.withColumn("width", F.when(none, F.col("w")).otherwise(F.col("width"))).withColumn("height", F.when(none, F.col("h")).otherwise(F.col("height"))).drop("w", "h")
