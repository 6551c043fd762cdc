import json

import pytest
from pyspark.sql import functions as F

from groundset.operators import pages, preference, sampling
from groundset.sources.jsonl import parse_line, scan_jsonl, typed_rows
from groundset.streaming.files import event_windows, stream_nodes, stream_records, stream_sample

MSG = "array<struct<role:string,content:array<struct<type:string,text:string,image:string>>>>"


def messages(spark, *ms):
    return spark.createDataFrame([(i, m) for i, m in enumerate(ms)], f"id int, messages {MSG}")


def text(t):
    return [("text", t, None)]


def test_message_rules(spark):
    df = messages(spark, [], [("bot", text("a"))], [("user", None)], [("user", [(None, "x", None)])], [("user", text("a")), ("assistant", text("b"))], [("system", text("s")), ("user", text("a"))], None)
    got = [r[0] for r in df.orderBy("id").select(preference.message_defect(F.col("messages"))).collect()]
    assert got[:6] == ["empty history", "bad role", "bad content", "bad content", "last turn is not a user's", None]


def test_strict_raises(spark):
    df = spark.createDataFrame([("p", None)], "prompt string, completion string")
    assert preference.convert(df, "sft").count() == 0
    with pytest.raises(Exception, match="no completion"):
        preference.convert(df, "sft", strict=True).collect()
    with pytest.raises(ValueError):
        preference.convert(df, "other")


def test_images_in_order(spark):
    m = [("user", [("image", None, "a.png"), ("text", "x", None)]), ("assistant", text("y")), ("user", [("image", None, "b.png"), ("text", "z", None)])]
    df = messages(spark, m).withColumn("prompt", F.lit(None).cast("string")).withColumn("completion", F.lit("c"))
    r = preference.convert(df, "sft").collect()[0]
    assert [i.path for i in r.images] == ["a.png", "b.png"]
    assert [[b.type for b in t.content] for t in r.prompt] == [["image", "text"], ["text"], ["image", "text"]]


def test_no_exchange_in_conversion(spark):
    df = spark.createDataFrame([("i", "p", "c", "d", True)], "image string, prompt string, chosen string, rejected string, label boolean").withColumn("completion", F.col("chosen"))
    for m in preference.METHODS:
        plan = preference.convert(df, m)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Python" not in plan


def test_json_lines(spark, tmp_path):
    rows = [{"prompt": "p", "completion": "c", "image": "i.png"}, {"messages": [{"role": "user", "content": "hi"}], "completion": "c"}, {"messages": [{"role": "user", "content": [{"type": "image", "image": "a"}, {"type": "text", "text": "t"}]}], "label": 1}, {"prompt": "p", "completion": "c", "label": True}]
    lines = [json.dumps(r) for r in rows] + ["", "  ", "{broken", '{"a":1}}', '{"a":1},{"b":2}', "[1]", "3"]
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    raw = scan_jsonl(spark, str(tmp_path))
    assert raw.count() == 9 and raw.where("v IS NULL").count() == 3
    with pytest.raises(Exception, match="broken line"):
        scan_jsonl(spark, str(tmp_path), strict=True).select(F.to_json("v")).collect()
    t = {r.raw: r for r in typed_rows(raw.select("raw")).collect()}
    assert t[lines[1]].messages[0].content[0].text == "hi"
    assert [b.type for b in t[lines[2]].messages[0].content] == ["image", "text"] and t[lines[2]].label is None
    assert t[lines[3]].label is True
    assert sum(r.defect == "malformed" for r in t.values()) == 5


def test_streams(spark, tmp_path):
    src, docs = tmp_path / "in", tmp_path / "docs"
    src.mkdir(), docs.mkdir()
    (src / "a.jsonl").write_text('{"prompt":"p","completion":"c"}\n{bad\n{"prompt":"q"}\n')
    q = stream_records(spark, str(src), "sft").writeStream.format("memory").queryName("recs").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("recs").count() == 1
    (docs / "a.xml").write_text("<a><b>t</b></a>")
    q = stream_nodes(spark, str(docs)).writeStream.format("memory").queryName("nodes").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("nodes").count() == 3
    num = tmp_path / "num"
    num.mkdir()
    for i in range(3):
        spark.range(i * 10, i * 10 + 10).coalesce(1).write.mode("append").parquet(str(num))
    s = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(num))
    q = stream_sample(s, ["id"], 5, str(tmp_path / "out")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out/2").collect())
    assert got == sorted(r.id for r in sampling.sample_global(spark.range(30), ["id"], 5).collect())


def test_event_windows(spark):
    e = spark.sql("SELECT timestamp_ntz'2024-01-01 00:10:00' AS ts, 'a' AS event_type, 1.0D AS value UNION ALL SELECT timestamp_ntz'2024-01-01 00:50:00', 'a', 2.0D UNION ALL SELECT timestamp_ntz'2024-01-01 01:00:00', 'a', 4.0D")
    assert sorted((r.events, r.total) for r in event_windows(e, "ts").collect()) == [(1, 4.0), (2, 3.0)]


def test_reading_order_and_type(spark):
    df = spark.createDataFrame([("readingOrder {index:3;}",), ("a {x:1;} readingOrder {index:12;} structure {type:heading;}",), ("",), (None,), ("readingOrder {index:1;} readingOrder {index:2;}",)], "c string")
    assert [r[0] for r in df.select(pages.reading_order(F.col("c"))).collect()] == [3, 12, None, None, 2]
    assert [r[0] for r in df.select(pages.region_type(F.col("c"))).collect()][1] == "heading"


def test_transcription_order(spark):
    ls = [(0, "a", 2, "third", None), (1, "b", None, "last", None), (2, "c", 0, "first", None), (3, "d", 1, " second ", None), (4, "e", 0, " ", None)]
    df = spark.createDataFrame([("p", 0, ls)], "doc_id string, region_no int, lines array<struct<idx:int,line_id:string,reading_order:int,text:string,bbox:string>>")
    assert pages.transcription(df).collect()[0].text == "first\nsecond\nthird\nlast"


def test_images(spark):
    im = spark.createDataFrame([("a", ".png", "a.png"), ("a", ".jpg", "a.jpg"), (None, ".png", "x"), ("b", ".tif", "b.tif")], "stem string, ext string, path string")
    assert {r.stem: r.path for r in pages.first_image(im).collect()} == {"a": "a.jpg", "b": "b.tif"}


def test_samples(spark):
    pool = spark.range(100)
    a = [r.id for r in sampling.sample_global(pool, ["id"], 10).collect()]
    assert len(set(a)) == 10 and a == [r.id for r in sampling.sample_global(pool.repartition(7), ["id"], 10).collect()]
    assert sampling.sample_global(pool, ["id"], 1000).count() == 100
    ls = spark.createDataFrame([("x", i) for i in range(10)] + [("y", 0)], "l string, n int")
    assert sampling.head_of_lists(ls, "l", "n", fixed=3).count() == 4
    assert sampling.head_of_lists(ls, "l", "n", fixed=3, relative=0.55).count() == 5
