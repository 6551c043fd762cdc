import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from groundset.operators import markup as M
from groundset.plans.rules import CASES
from groundset.sources.xml import class_polygons, declared_size, page_lines, page_xml, shred, shred_text, zones


def doc(inner, version="0.7"):
    return f'<doclang xmlns="{M.NAMESPACE}" version="{version}">{inner}</doclang>'


LOC = '<location value="1"/><location value="2"/><location value="3"/><location value="4"/>'
GOOD = [
    "<text>a</text>", f"<text><label value=\"x\"/><thread thread_id=\"1\"/><layer value=\"body\"/>{LOC}a <bold>b</bold></text><text><xref thread_id=\"1\"/>c</text>",
    '<list class="ordered"><ldiv/>a<ldiv><marker>1</marker></ldiv>b<text>c</text></list>', "<table><ched/>a<ched/>b<nl/><fcel/>c<ecel/><nl/></table>", '<picture class="chart"><src uri="u"/><tabular><fcel/>a</tabular></picture>',
    "<field_region><field_item><key>k</key><value class=\"read_only\">v</value></field_item></field_region>", "<group>\n<heading level=\"2\">h</heading>\n</group><page_break/>", "<head><default_resolution width=\"10\" height=\"10\"/><meta/></head><text>" + LOC + "x</text>", "<code>c<checkbox class=\"selected\"/></code>",
]


def test_rules(spark):
    """Every case of the rule queries, sound and broken; no rule speaks about GOOD."""
    docs = [(f"good{i}", doc(g)) for i, g in enumerate(GOOD)]
    for name, (rule, _, sound, broken, _, opening) in CASES.items():
        docs += [(f"sound {name}", doc(opening + sound)), (f"broken {name}|{rule}", doc(opening + broken, "0.6" if rule == "version" else "0.7"))]
    docs += [("null", None)]
    nodes = shred(spark.createDataFrame(docs, "id string, content string"), "id", "content").cache()
    found = {}
    for r in M.violations(nodes).collect():
        found.setdefault(r.doc_id, set()).add(r.rule)
    assert {d: rs for d, rs in found.items() if d.startswith("good") or d.startswith("sound")} == {}
    for name, _ in docs:
        if "|" in name:
            assert name.split("|")[1] in found.get(name, set()), name
    assert {r for rs in found.values() for r in rs} == set(M.RULES)
    with pytest.raises(ValueError):
        M.violations(nodes, ("no_such_rule",))


def _find(rows, tag):
    return [r for r in rows if r[5] == tag]


def test_shredder_numbers():
    rows, error = shred_text('<a xmlns="n" x="1">t<b>u<c/>v</b>w<d/></a>')
    assert error is None and [r[5] for r in rows] == ["a", "#text", "b", "#text", "c", "#text", "#text", "d"]
    assert [r[0] for r in rows] == list(range(8)) and rows[0][2] == 7 and _find(rows, "b")[0][2] == 5
    assert [r[4] for r in rows] == [0, 0, 1, 0, 1, 2, 2, 3]


def test_shredder_refuses(spark):
    assert shred_text("<!DOCTYPE a [<!ENTITY x 'y'>]><a>&x;</a>")[1] == "document type"
    assert shred_text("<a>" + "x" * 200_000 + "<!DOCTYPE a></a>")[1] == "document type" and shred_text("<a>" + "x" * 200_000 + "</a>")[1] is None
    assert shred_text("<b/>", ("a",))[1] == "root element b" and shred_text('<a xmlns="n"><b xmlns="m"/></a>')[1] == "second namespace {m}" and shred_text('<a xmlns="n"><b/></a>', ("a",))[1] is None
    df = spark.createDataFrame([("a", "<a"), ("b", None), ("c", "")], "id string, t string")
    assert shred(df, "id", "t").where("error IS NOT NULL").count() == 2


chunk = st.builds(lambda t: {"type": "text_chunk", "text": t}, st.text("ab &<>\"é ", max_size=6))
leaf = st.one_of(chunk, st.builds(lambda t: {"type": "content", "text": t}, st.one_of(st.none(), st.text("a <", max_size=3))))
inline = st.recursive(leaf, lambda k: st.builds(lambda b, t: {"type": t, "body": b}, st.lists(k, max_size=3), st.sampled_from(["bold", "italic"])), max_leaves=6)
block = st.builds(lambda b, t, lv: {"type": t, "body": b, **({"level": lv} if t == "heading" else {})}, st.lists(inline, max_size=3), st.sampled_from(["text", "heading", "code"]), st.one_of(st.none(), st.integers(1, 4)))


@settings(max_examples=60, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(block, max_size=4))
def test_rendering_keeps_text(body):
    def said(n):
        return n.get("text") or "" if "text" in n else "".join(map(said, n.get("body", [])))

    out = M.render_document('{"items": []}', json.dumps(body))
    rows, error = shred_text(out)
    assert error is None
    assert "".join(r[8] for r in rows if r[5] == "#text") == "".join(map(said, body))


def test_rendering_order_and_failures():
    node = {"type": "text", "head": {"summary": {"type": "summary", "body": []}, "href": {"type": "href", "uri": 'a"&'}, "xref": None, "locations": [{"type": "location", "value": 3, "resolution": 9}], "label": {"type": "label", "value": None}}, "body": [{"type": "text_chunk", "text": " x"}]}
    assert M.render(node) == '<text><label/><href uri="a&quot;&amp;"/><location value="3" resolution="9"/><summary></summary><content> x</content></text>'
    for bad in ("", None, "{", '{"a":1}', '[{"type":"nonsense"}]', "[3]"):
        assert M.render_document(None, bad) is None


def test_node_text(spark):
    t = doc(f"<text>{LOC}<caption>cap</caption>a<list><ldiv/>hidden</list><bold>b</bold><text>c</text></text>")
    n = shred(spark.createDataFrame([("d", t)], "id string, c string"), "id", "c")
    assert sorted(r.text for r in M.node_text(n, "text").collect()) == ["abc", "c"]
    assert [tuple(r.bbox) for r in M.text_pairs(n).collect()] == [(1, 2, 3, 4)]


def test_mutants(spark):
    d = spark.createDataFrame([("a", doc("<footnote>x</footnote><table><fcel/>a<ecel/><nl/></table>")), ("b", doc('<text><thread thread_id="1"/><layer value="body"/><href uri="u"/>x</text>'))], "doc_id string, content string")
    got = {(r.doc_id, r.mutation): r.content for r in M.mutants(d).collect()}
    assert "<page_header>x</page_header>" in got[("a", "swap_tag")]
    assert "<nl/>" not in got[("a", "drop_tag")] and "<ecel/>" not in got[("a", "break_table")]
    assert '<layer value="bogus"/>' in got[("b", "bogus_value")] and '<layer value="body"/><thread' in got[("b", "reorder_head")]
    assert ("a", "two_links") not in got and '<xref thread_id="1"/><href' in got[("b", "two_links")]


def test_pages(spark):
    box = (1, 2, 30, 40)
    rs = [("d", 0, "r1", 100, 200, box, [(0, "l1", 0, "a & b", box), (1, "l2", None, None, None)]), ("d", 1, "r2", 100, 200, None, None)]
    df = spark.createDataFrame(rs, "doc_id string, region_no int, region_id string, page_w int, page_h int, bbox struct<x1:int,y1:int,x2:int,y2:int>, lines array<struct<idx:int,line_id:string,reading_order:int,text:string,bbox:struct<x1:int,y1:int,x2:int,y2:int>>>")
    n = shred(page_xml(df), "doc_id", "content")
    ls = {r.line_id: r for r in page_lines(n).collect()}
    assert ls["l1"].text == "a & b" and ls["l1"].custom == "readingOrder {index:0;}" and ls["l2"].points is None and ls["l2"].text is None
    assert [tuple(r) for r in declared_size(n).collect()] == [("d", 100, 200)]
    assert [(r.zone, r.tag) for r in zones(n, ["TextRegion", "TextLine"]).orderBy("zone").collect()] == [(0, "TextRegion"), (1, "TextRegion"), (2, "TextLine"), (3, "TextLine")]
    from pyspark.sql import functions as F

    assert class_polygons(n, {"p": 1}, F.lit("p")).count() == 1 and class_polygons(n, {"q": 1}, F.lit("p")).count() == 0


def test_class_polygons_grouped(spark):
    """Regions and their Coords without a join, whose sides' sizes can't be known, in one pass over the nodes; of each region all its polygons, of its lines none."""
    from pyspark.sql import functions as F

    three, four = "0,0 1,0 1,1", "0,0 2,0 2,2 0,2"
    line = f'<TextLine id="l"><Coords points="{four}"/></TextLine>'
    inner = {
        "one": f'<Coords points="{four}"/>{line}', "two": f'<Coords points="{four}"/><Coords points="{three}"/>', "few": '<Coords points="0,0 1,1"/>', "bare": "<Coords/>", "none": line, "bad": '<Coords points="a,b 1,1 2,2"/>',
        "other": f'<Coords points="{four}"/>', "nested": f'<Coords points="{three}"/><TextRegion id="one"><Coords points="{four}"/></TextRegion>',
    }
    page = "<PcGts><Page>" + f'<Coords points="{four}"/>' + "".join(f'<TextRegion id="{k}">{v}</TextRegion>' for k, v in inner.items()) + f'<TextRegion><Coords points="{three}"/></TextRegion></Page></PcGts>'
    nodes = shred(spark.createDataFrame([("a", page), ("b", page), ("c", "<PcGts"), (None, page)], "id string, content string"), "id", "content")
    p = class_polygons(nodes, {"x": 1, "y": 2}, F.when(F.col("attrs")["id"] == "two", "y").when(F.coalesce(F.col("attrs")["id"], F.lit("")) != "other", "x"))
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("MapInArrow") == 1
    each = [("", 1, 3), ("nested", 1, 3), ("one", 1, 4), ("one", 1, 4), ("two", 2, 3), ("two", 2, 4)]
    assert sorted((r.doc_id, r.region_id or "", r.class_id, len(r.points)) for r in p.collect()) == [(d, *x) for d in "ab" for x in each]
