import struct
import zlib

from pyspark.sql import functions as F

from groundset.config import DataConfig, RunConfig, from_mapping, metadata
from groundset.functions.text import data_uri
from groundset.operators.generate import generate, rewards
from groundset.sources import images, xml


def png(w, h):
    def part(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + part(b"IEND", b"")


JPEG = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08" + struct.pack(">HH", 7, 9) + b"\x03" + b"\0" * 9
TIFF = b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", 2) + struct.pack("<HHII", 256, 3, 1, 11) + struct.pack("<HHII", 257, 4, 1, 12)


def test_headers():
    assert images.header_size(png(8, 5)) == (8, 5) and images.header_size(JPEG) == (9, 7) and images.header_size(TIFF) == (11, 12)
    assert images.header_size(b"GIF89a" + struct.pack("<HH", 3, 4)) == (3, 4)
    assert images.header_size(b"BM" + b"\0" * 16 + struct.pack("<ii", 5, -6)) == (5, 6)
    for b in (b"", b"nothing", b"\x89PNG\r\n\x1a\n", JPEG[:9], b"II*\0\xff\xff\xff\xff"):
        assert images.header_size(b) is None


def test_files(spark, tmp_path):
    (tmp_path / "a.PNG").write_bytes(png(8, 8))
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.jpg").write_bytes(JPEG)
    (tmp_path / "c.txt").write_text("x")
    assert sorted((r.stem, r.ext) for r in images.find(spark, str(tmp_path)).collect()) == [("a", ".png"), ("b", ".jpg")]
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path))
    docs = f.select("path").withColumn("width", F.when(F.col("path").endswith("jpg"), 100)).withColumn("height", F.col("width"))
    got = {r.path[-5:]: (r.width, r.height) for r in images.with_size(docs, f).collect()}
    assert got == {"a.PNG": (8, 8), "b.jpg": (100, 100), "c.txt": (None, None)}
    u = f.where(F.col("path").endswith("txt")).select(data_uri(F.col("path"), F.col("content")).alias("u")).collect()[0].u
    assert u == "data:image/png;base64,eA=="


def test_document_scan(spark, tmp_path):
    for n in ("b.xml", "a.xml", "c.dclg", "d.txt"):
        (tmp_path / n).write_text("<a/>")
    got = [(r.stem, r.suffix) for r in xml.scan_documents(spark, str(tmp_path)).orderBy("rank", "path").collect()]
    assert got == [("a", ".xml"), ("b", ".xml"), ("c", ".dclg")]


def test_generate(spark):
    df = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "none"), (4, None)], "id long, p string")
    got = {r.id: (r.output, r.attempts, r.error) for r in generate(df, "id", "p", lambda p: "" if p == "none" else p, lambda o: None if o == "good" else "wrong", 3).collect()}
    assert got == {1: ("good", 1, None), 2: (None, 3, "wrong"), 3: (None, 1, "empty answer"), 4: (None, 0, "no prompt")}
    r = rewards(df, "id", "p", [lambda s: s.fillna("").str.len(), lambda s: s.notna()]).orderBy("id").collect()
    assert [(x.reward_0, x.reward_1) for x in r] == [(4.0, 1.0), (3.0, 1.0), (4.0, 1.0), (0.0, 0.0)]


def test_config():
    c = from_mapping(RunConfig, {"method": "dpo", "data": {"train_path": "x", "nonsense": 1}, "build": None, "more": 2})
    assert c.method == "dpo" and c.data == DataConfig(train_path="x") and c.build.max_n == 3
    m = metadata(c)
    assert len(m["config_hash"]) == 8 and m["config_hash"] == metadata(from_mapping(RunConfig, m["config"]))["config_hash"]
