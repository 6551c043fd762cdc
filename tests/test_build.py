import json
import struct

import pytest
from pyspark.sql import functions as F

from groundset import config
from groundset.__main__ import main
from groundset.operators import build as B
from groundset.operators import inventory as I
from groundset.operators import markup as M
from groundset.operators import sampling
from groundset.sources import images
from groundset.sources.xml import PAGE_NAMESPACE, with_size


def png(w, h):
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", w, h) + b"\x08\x02\0\0\0" + b"\0" * 40


def page(inner, size='imageWidth="200" imageHeight="100"', ns=PAGE_NAMESPACE):
    return f'<PcGts xmlns="{ns}"><Metadata/><Page {size}>{inner}</Page></PcGts>'


def line(i, x, text, points=True, equiv=None):
    at = f'<Coords points="{x},{10 * i} {x + 50},{10 * i} {x + 50},{10 * i + 8}"/>' if points else ""
    return f'<TextLine id="l{i}">{at}{equiv or f"<TextEquiv><Unicode>{text}</Unicode></TextEquiv>"}</TextLine>'


NESTED = '<TextRegion id="r1"><Coords points="0,0 200,90"/>' + line(1, 0, "one") + '<TextRegion id="r2"><Coords points="0,0 100,40"/>' + line(2, 0, "two") + line(3, 0, "three") + "</TextRegion></TextRegion>"
LOC = '<location value="1"/><location value="2"/><location value="30"/><location value="40"/>'
FILES = {
    "a.xml": page(NESTED + line(4, 0, "loose")), "b.xml": page("<TextRegion><Coords/>" + line(1, 0, " ") + line(2, 0, "x", points=False) + "</TextRegion>"), "c.xml": "<PcGts><Page>", "d.xml": page(NESTED, size=""), "e.xml": page(NESTED), "f.xml": "<html><body/></html>",
    "g.xml": page(NESTED.replace("<TextEquiv>", '<TextEquiv xmlns="urn:other">')), "m.dclg": f'<doclang xmlns="{M.NAMESPACE}" version="0.7"><head><default_resolution width="100" height="50"/></head><text>{LOC} said <bold>so</bold> </text><text>no box</text></doclang>',
    "n.dclg": f'<doclang xmlns="{M.NAMESPACE}" version="0.7"><text>{LOC}good</text><text><location value="1"/><location value="2"/><location value="30"/>three</text></doclang>',
}
SIZES = {"a.png": (9, 9), "a.jpg": None, "b.png": (9, 9), "c.png": (9, 9), "d.png": (400, 200), "f.png": (9, 9), "g.png": (9, 9), "m.png": (9, 9), "n.png": (9, 9)}


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    docs, pics = tmp_path_factory.mktemp("docs"), tmp_path_factory.mktemp("pics")
    for name, text in FILES.items():
        (docs / name).write_text(text, encoding="utf-8")
    for name, size in SIZES.items():
        (pics / name).write_bytes(png(*size) if size else b"not a picture")
    return str(docs), str(pics)


def test_line_modes_take_both_kinds_of_files(spark, folders):
    b = B.build_folder(spark, *folders, "bbox_to_text", "doclang")
    got = {(r.doc_id.rsplit("/", 1)[1], r.completion) for r in b.candidates.collect()}
    assert got == {("a.xml", t) for t in ("one", "two", "three", "loose")} | {("d.xml", t) for t in ("one", "two", "three")} | {("m.dclg", "said so")}
    skips = {r.doc_id.rsplit("/", 1)[1]: r.reason for r in b.skips.collect()}
    assert skips == {"b.xml": B.UNUSABLE, "c.xml": B.UNREADABLE, "e.xml": B.NO_IMAGE, "f.xml": B.UNREADABLE, "g.xml": B.UNREADABLE, "n.dclg": B.UNREADABLE}
    r = b.records.where(F.col("completion")[0]["content"][0]["text"] == "one").orderBy("images").first()
    assert [x["type"] for x in r.prompt[0].content] == ["image", "text"] and r.images[0].path.endswith("a.jpg")


def test_region_modes(spark, folders):
    b = B.build_folder(spark, *folders, "region_to_transcription", "qwen")
    got = sorted((r.doc_id.rsplit("/", 1)[1], r.prompt.split("paragraph ")[1].split(",")[2], r.completion) for r in b.candidates.collect())
    # a nested region's lines stand in both; d.xml takes its size from its image
    assert got == [("a.xml", " 1000", "one\ntwo\nthree"), ("a.xml", " 500", "two\nthree"), ("d.xml", " 250", "two\nthree"), ("d.xml", " 500", "one\ntwo\nthree")]
    assert B.build_folder(spark, *folders, "line_neighbor", "qwen").candidates.count() == 2 * 8 * (2 + 1 + 1)
    assert B.build_folder(spark, *folders, "line_neighbor", "qwen", max_n=1).candidates.count() == 2 * 8 * (2 + 1)
    few = B.build_folder(spark, *folders, "line_index", "qwen", max_lines=5)
    again = B.build_folder(spark, *folders, "line_index", "qwen", max_lines=5)
    assert few.candidates.count() == 5 and few.candidates.exceptAll(again.candidates).count() == 0
    with pytest.raises(ValueError):
        B.build_folder(spark, *folders, "no_mode", "qwen")
    with pytest.raises(ValueError):
        B.build_folder(spark, *folders, "line_count", "qwen", max_lines=0)


def test_text_of_a_line_falls_back_to_the_first_child(spark):
    from groundset.sources.xml import page_lines, shred

    t = page('<TextRegion id="r">' + line(1, 0, "", equiv="<TextEquiv><PlainText>plain</PlainText></TextEquiv>") + line(2, 0, "", equiv="<TextEquiv><PlainText>plain</PlainText><Unicode>uni</Unicode></TextEquiv>") + "</TextRegion>")
    rows = page_lines(shred(spark.createDataFrame([("d", t)], "id string, t string"), "id", "t")).orderBy("line_no").collect()
    assert [r.text for r in rows] == ["plain", "uni"]
    df = spark.createDataFrame([("d", t, 7, None)], "id string, t string, w int, h int")
    assert 'imageWidth="7" imageHeight="100"' in df.select(with_size(F.col("t"), F.col("w"), F.col("h"))).first()[0]


def test_command_line(spark, folders, tmp_path):
    out = str(tmp_path / "out")
    assert main(["line_count", "--input", folders[0], "--images", folders[1], "--output", out]) == {"records": 4, "skipped": 5}
    assert main(["transcription", "--input", folders[0], "--images", folders[1], "--output", out])["records"] == 3
    assert main(["markup", "--input", folders[0], "--images", folders[1], "--output", out])["records"] == 1
    assert spark.read.parquet(out).first().completion[0].content[0].text.startswith("<doclang")
    with pytest.raises(SystemExit):
        main(["line_count", "--input", "x", "--images", "y", "--output", "z", "--max-n", "0"])


def test_sizes_read_headers_only(spark, folders, tmp_path):
    found = {r.path.rsplit("/", 1)[1]: (r.width, r.height) for r in images.sizes(images.find(spark, folders[1])).collect()}
    assert found["d.png"] == (400, 200) and found["a.jpg"] == (None, None)
    assert images.first_bytes(str(tmp_path / "none.png")) is None and len(images.first_bytes(f"{folders[1]}/d.png", 10)) == 10


def test_inventories_agree(spark):
    items = I.inventories(spark)
    assert I.differences(items).count() == 0 and items.select("source").distinct().count() == 4
    broken = I.grammar().replace('"<hint"', '"<hints"')
    assert I.grammar_inventory(broken) ^ I.rules_inventory() == {("element", "hint"), ("element", "hints")}
    assert I.inferred_root(I.child_edges(spark)).first().root == "doclang"


def test_schema_is_strict():
    def objects(node):
        if isinstance(node, dict):
            if node.get("type") == "object":
                yield node
            for v in node.values():
                yield from objects(v)
        elif isinstance(node, list):
            for v in node:
                yield from objects(v)

    schema = I.json_schema()
    assert all(o["additionalProperties"] is False for o in objects(schema)) and len(list(objects(schema))) > 50
    assert json.dumps(schema) == json.dumps(I.json_schema()) and schema["$defs"]["location"]["properties"]["value"] == {"type": "integer", "minimum": 0}
    dirty = {"type": "object", "title": "t", "properties": {"title": {"type": "string", "default": "x", "description": "d"}, "a": {"anyOf": [{"properties": {}}]}}}
    assert I.strict(dirty, ()) == {"type": "object", "properties": {"title": {"type": "string"}, "a": {"anyOf": [{"properties": {}, "additionalProperties": False}]}}, "additionalProperties": False}
    assert I.response_format()["json_schema"]["strict"] is False


def test_grammar_in_another_dialect():
    text = I.lark(I.grammar())
    assert "::=" not in text and text.startswith("start: ") and "/[^<>&]/+" in text.replace("]+/", "]/+") or "/[^<>&]+/" in text
    assert len(text.splitlines()) == len(I.grammar().splitlines()) and '"<field_item"' in text


def test_configuration(tmp_path):
    p = tmp_path / "run.yaml"
    p.write_text("method: dpo\nmodel:\n  lora_r: 8\n  unknown: 1\ndata:\n  train_path: x.jsonl\ngrpo:\nother: 3\n")
    c = config.load(p)
    assert (c.method, c.model.lora_r, c.model.lora_alpha, c.data.train_path, c.training.seed, c.grpo.beta) == ("dpo", 8, 32, "x.jsonl", 42, 0.0)
    assert config.load(None) == config.RunConfig() and config.RunConfig().model.lora_target_modules is not config.RunConfig().model.lora_target_modules
    m = config.metadata(c, "abc")
    assert m["config"]["model"]["lora_r"] == 8 and len(m["config_hash"]) == 8 and m["config_hash"] != config.metadata(config.RunConfig())["config_hash"]
    assert config.run_folder(tmp_path, c).is_dir() and config.run_folder(tmp_path, c) == config.run_folder(tmp_path, c)


def test_heads_of_lists(spark, tmp_path):
    rows = [("a", i) for i in range(1000)] + [("b", i) for i in range(7)] + [("c", 5)]
    df = spark.createDataFrame(rows, "source string, doc_id long").repartition(5)
    got = {s: sorted(r.doc_id for r in sampling.head_of_lists(df, "source", "doc_id", fixed=3).collect() if r.source == s) for s in "abc"}
    assert got == {"a": [0, 1, 2], "b": [0, 1, 2], "c": [5]}
    got = {s: sorted(r.doc_id for r in sampling.head_of_lists(df, "source", "doc_id", relative=0.3).collect() if r.source == s) for s in "abc"}
    assert got == {"a": list(range(300)), "b": [0, 1], "c": []}
    assert sampling.head_of_lists(df.limit(0), "source", "doc_id", relative=0.3).count() == 0
    names = df.select("source", F.concat(F.lit("p"), F.format_string("%04d", "doc_id")).alias("path"))
    assert sampling.head_of_lists(names, "source", "path", relative=0.1).count() == 100
    sampling.write_lists(names.limit(4), "path", str(tmp_path / "list"))
    sampling.write_lists(names.limit(4), "path", str(tmp_path / "list"))
    assert spark.read.text(str(tmp_path / "list")).count() == 4
