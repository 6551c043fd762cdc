import json

import pytest
from pyspark.sql import functions as F

from groundset.operators.nested import array_nodes, inside, json_nodes, load, parse_deep, tables_by_type

BODY = [{"type": "text", "head": {"label": {"type": "label"}}, "body": [{"type": "bold", "body": [{"type": "text_chunk", "text": "a"}]}]}, {"type": "list", "items": [{"ldiv": {"type": "ldiv"}, "body": [{"type": "text_chunk", "text": "b"}, {"type": None, "body": [{"type": "code"}]}]}]}]


def test_keys_and_parents(spark):
    df = spark.createDataFrame([("d", None, json.dumps(BODY), 5)], "doc_id string, head string, body string, rid int")
    got = {r.node_key: r.parent_key for r in json_nodes(df, F.col("doc_id"), ["head", "body"]).collect()}
    assert got == {
        "body.0": "", "body.0.head.label": "body.0", "body.0.body.0": "body.0", "body.0.body.0.body.0": "body.0.body.0",
        "body.1": "", "body.1.items.0.ldiv": "body.1", "body.1.items.0.body.0": "body.1", "body.1.items.0.body.1.body.0": "body.1",
    }


def test_intervals_hold_parents(spark):
    df = spark.createDataFrame([("d", json.dumps(BODY))], "doc_id string, body string")
    n = json_nodes(df, F.col("doc_id"), ["body"]).collect()
    by = {r.node_key: r for r in n}
    for r in n:
        around = [x for x in n if x.pre < r.pre and r.post < x.post]
        assert (max(around, key=lambda x: x.pre).node_key if around else "") == r.parent_key
        assert r.pre < r.post and (r.parent_pre is None) == (r.parent_key == "")
    nodes = json_nodes(df, F.col("doc_id"), ["body"])
    t = tables_by_type(nodes, ["list", "text_chunk"])
    assert [(r.outer_key, r.inner_key) for r in inside(t["list"], t["text_chunk"]).collect()] == [("body.1", "body.1.items.0.body.0")]
    assert by["body.0"].depth == 0 and by["body.0.body.0.body.0"].depth == 2


@pytest.mark.parametrize("bad", ["", "[", '[{"type":"a"}', "{'a':1}", "[1,]", "nul", "[NaN]", '["a" "b"]', '{"a" 1}', "[1] 2", "]"])
def test_broken_json(spark, bad):
    df = spark.createDataFrame([("d", bad)], "doc_id string, body string")
    assert json_nodes(df, F.col("doc_id"), ["body"]).count() == 0
    with pytest.raises(ValueError):
        parse_deep(bad)


@pytest.mark.parametrize("text", ['[1, -2.5e3, "a\\u00e9\\n", true, null, {"a": {"b": [[]]}}]', "{}", "[]", '"x"', " [ ] "])
def test_deep_parser_agrees(text):
    assert parse_deep(text) == json.loads(text) == load(text)


def test_very_deep(spark):
    made = lambda n: "[" + '{"type":"a","body":[' * n + "]}" * n + "]"
    df = spark.createDataFrame([("d", made(2000))], "doc_id string, body string")
    n = json_nodes(df, F.col("doc_id"), ["body"])
    assert n.agg(F.max("depth")).collect()[0][0] == 1999
    assert isinstance(load(made(200_000)), list)


def test_arrays(spark):
    t = "doc_id string, region_id string, lines array<struct<idx:int,text:string>>, node_key string"
    df = spark.createDataFrame([("d", "r1", [(0, "a"), None, (1, "b")], "clash"), ("d", "r2", None, None), ("d", "r3", [], None), ("d", None, [(0, "x")], None)], t)
    got = sorted((r.node_key, r.parent_key, r.pre, r.post) for r in array_nodes(df, "doc_id", "region_id", "lines", "idx").collect())
    assert got == [("r1", "", 0, 5), ("r1.0", "r1", 1, 2), ("r1.1", "r1", 3, 4), ("r2", "", 0, 1), ("r3", "", 0, 1)]
    assert array_nodes(df.limit(0), "doc_id", "region_id", "lines", "idx").count() == 0


def test_texts_no_column_can_hold(spark):
    """Lone surrogates and numbers of any length are read like the rest, beside sound rows."""
    rows = [("a", '[{"type": "text", "text": "\\ud800x", "n": 3}]'), ("b", '[{"type": "text", "n": ' + "9" * 5000 + "}]"), ("c", '[{"type": "text", "text": "é"}]')]
    got = {r.rid: r for r in json_nodes(spark.createDataFrame(rows, "id string, body string"), F.col("id"), ["body"]).collect()}
    assert got["a"].text == "?x" and len(got["b"].attrs["n"]) >= 5000 and got["c"].text == "é"
    from groundset.operators.markup import render_document

    assert render_document(None, '[{"type": "text", "body": [{"type": "text_chunk", "text": "\\ud800x"}]}]').endswith("<text>?x</text></doclang>")


def test_blank_runs_in_fields_give_nothing():
    from groundset.operators.markup import render

    blank = {"type": "text_chunk", "text": " "}
    assert render({"type": "field_region", "body": [blank, {"type": "field_item", "body": [blank, {"type": "key", "body": [blank]}]}]}) == "<field_region><field_item><key><content> </content></key></field_item></field_region>"
