import pytest
from pyspark.sql import functions as F

from groundset.functions import geometry as G
from groundset.functions.text import content_markup, ordinal, strip, strip_ansi, xml_attribute
from groundset.operators import tasks

SCHEMA = "doc_id string, region_no int, page_w int, page_h int, bbox struct<x1:int,y1:int,x2:int,y2:int>, lines array<struct<idx:int,line_id:string,reading_order:int,text:string,bbox:struct<x1:int,y1:int,x2:int,y2:int>>>, extra string"


def region(n, no=0, w=1000, h=1000, lines=None):
    ls = lines if lines is not None else [(i, f"l{i}", i, f"t{i}", (0, 10 * i, 100, 10 * i + 8)) for i in range(n)]
    return ("d", no, w, h, (0, 0, 200, 200), ls, "x")


def rows(spark, data, mode, fmt="qwen", **kw):
    return [(r.prompt, r.completion) for r in tasks.build(spark.createDataFrame(data, SCHEMA), mode, fmt, **kw).collect()]


def test_neighbour_counts(spark):
    for n, k in ((3, 1), (4, 1), (4, 2), (1, 2)):
        want = 8 * sum(max(0, n - i) for i in range(1, k + 1))
        assert len(rows(spark, [region(n)], "line_neighbor", max_n=k)) == want


def test_half_even_rounding(spark):
    r = spark.sql("SELECT 5 AS v, 2000 AS d UNION ALL SELECT 15, 2000 UNION ALL SELECT 4000, 1000 UNION ALL SELECT -3, 10 UNION ALL SELECT 1, 0")
    assert [x[0] for x in r.select(G.grid(F.col("v"), F.col("d"))).collect()] == [2, 8, 1000, 0, None]


@pytest.mark.parametrize("mode,least", [("region_to_lines", 2), ("lines_to_region", 2), ("region_to_transcription", 2), ("line_index", 2), ("line_ordering", 3), ("line_count", 1)])
def test_least_lines(spark, mode, least):
    assert rows(spark, [region(least - 1)], mode) == []
    assert rows(spark, [region(least)], mode)


def test_ordering_round_trip(spark):
    (prompt, answer), = rows(spark, [region(6, h=1000)], "line_ordering", fmt="doclang")
    shown = [int(b.split(", ")[1]) for b in prompt.split("order: [[")[1].split("]]")[0].split("], [")]
    assert [shown[int(i) - 1] for i in answer.split(", ")] == [10 * i for i in range(6)]
    assert shown != [10 * i for i in range(6)]


def test_exact_strings(spark):
    assert rows(spark, [region(1)], "bbox_to_text") == [("Transcribe the text inside the bounding box [0, 0, 100, 8]. All bounding-box coordinates are integers normalized to the 0-1000 range.", "t0")]
    assert rows(spark, [region(1)], "text_to_bbox", "doclang")[0][1] == '<text><location value="0"/><location value="0"/><location value="100"/><location value="8"/>t0</text>'
    assert rows(spark, [region(2)], "line_index")[3][1] == "line 2 of 2"


def test_dirty_rows_give_nothing(spark):
    box = (0, 0, 1, 1)
    bad = [("d", 0, 10, 10, box, None, "x"), ("d", 1, 10, 10, box, [], "x"), ("d", 2, 10, 10, box, [(0, "a", None, "  ", box), (1, "b", None, None, box), (2, "c", None, "t", None)], "x"), ("d", 3, 0, 10, box, [(0, "a", 0, "t", box)], "x"), ("d", 4, 10, 10, None, [(0, "a", 0, "t", box)], "x"), (None, None, None, None, None, None, None)]
    for mode in tasks.MODES:
        assert rows(spark, bad, mode) == []
    assert rows(spark, [], "line_count") == []


def test_no_exchange_in_any_task(spark):
    df = spark.createDataFrame([region(3)], SCHEMA)
    for mode in tasks.MODES:
        for fmt in G.FORMATS:
            plan = tasks.build(df, mode, fmt)._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "Python" not in plan, mode


def test_unknown_arguments(spark):
    df = spark.createDataFrame([region(3)], SCHEMA)
    with pytest.raises(ValueError):
        tasks.build(df, "nothing", "qwen")
    with pytest.raises(ValueError):
        tasks.build(df, "line_count", "other")
    with pytest.raises(ValueError):
        tasks.build(df, "line_neighbor", "qwen", max_n=0)


def test_scalars(spark):
    r = spark.createDataFrame([(n,) for n in (1, 2, 3, 4, 10, 11, 12, 13, 20, 21, 111, 112, 101)], "n int")
    assert [x[0] for x in r.select(ordinal(F.col("n"))).collect()] == "1st 2nd 3rd 4th 10th 11th 12th 13th 20th 21st 111th 112th 101st".split()
    t = spark.createDataFrame([("   a b\x1c\n",), ("",), (None,)], "t string")
    assert [x[0] for x in t.select(strip(F.col("t"))).collect()] == ["a b", "", None]
    e = spark.createDataFrame([('a&<">',), (" a",), ("",)], "t string")
    assert [x[0] for x in e.select(xml_attribute(F.col("t"))).collect()][0] == "a&amp;&lt;&quot;&gt;"
    assert [x[0] for x in e.select(content_markup(F.col("t"))).collect()][1:] == ["<content> a</content>", ""]
    a = spark.createDataFrame([("\x1b[1;31mx\x1b[0m",)], "t string")
    assert a.select(strip_ansi(F.col("t"))).collect()[0][0] == "x"


def test_points(spark):
    p = spark.createDataFrame([("1,2 3,4",), ("5,6",), ("",), (None,), ("1,a 2,3",), ("1",), ("1,2,9 3,0",)], "p string")
    got = [x[0] and tuple(x[0]) for x in p.select(G.hull(G.parse_points(F.col("p")))).collect()]
    assert got == [(1, 2, 3, 4), (5, 6, 5, 6), None, None, None, None, (1, 0, 3, 2)]


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and len(q) > 60
