import itertools

import pytest

from groundset.llm.canon import Transducer, canonical, canonical_form, look_alike_pairs, transducer

SAME = [("Kenver", "Kenνer"), ("étang", "étang"), ("oﬀ", "off"), ("ｆｕｌｌ．", "full."), ("a b", "a b"), ("a​b", "ab"), ("Ａ", "А"), ("K", "K"), ("å", "å"), ("Å", "Å"), ("a\tb", "a b"), ("­", ""), ("ё", "ë"), ("two‑", "two-"), ("ḗ", "ḗ")]
DIFFERENT = [("a", "A"), ("e", "é"), ("2", "²"), ("s", "ſ"), ("a b", "b a"), ("a.", "a"), ("-", "–"), ("ß", "ss"), ("l", "1"), ("O", "0"), ("λ", "a"), ("ﬅ", "st")]


@pytest.mark.parametrize("a,b", SAME)
def test_same(a, b):
    assert canonical(a) == canonical(b)


@pytest.mark.parametrize("a,b", DIFFERENT)
def test_different(a, b):
    assert canonical(a) != canonical(b)


@pytest.mark.parametrize("sign", "\t\n\r\x0b\x0c")
def test_inner_control_signs_are_blanks(sign):
    assert canonical(f"a{sign}b") == canonical("a b") == canonical(f"ａ{sign}b") == "a b"


def test_idempotent_and_whole():
    t = transducer()
    for s in [x for p in SAME + DIFFERENT for x in p] + ["", " ", "́", "x" * 200_000 + "ｅ"]:
        assert t.apply(t.apply(s)) == t.apply(s)
    assert len(canonical("x" * 200_000 + "ｅ")) == 200_001


def test_compilation_checks():
    with pytest.raises(ValueError, match="two targets"):
        Transducer([("x", "a"), ("x", "b")])
    with pytest.raises(ValueError, match="fixed point"):
        Transducer([("х", "ж"), ("ж", "z")])
    with pytest.raises(ValueError, match="equal"):
        Transducer([("ſ", "s")])


def test_longest_match_first():
    assert Transducer([("¤", "1"), ("¤¢", "2")]).cluster("¤¢") == "2"


def test_pairs_against_brute_force(spark):
    texts = [None, "", "  ", "​", "abc", "abc", " abc ", "аbc", "a​bc", "ABC", "ｅ́t", "ét", "ét", "et", "abc ", "abc​"]
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(4, "abc", "x", "z"), (None, "abc", "x", "y")]
    df = spark.createDataFrame(rows, "id long, text string, form string, salt string")
    got = {(r.id_a, r.id_b) for r in look_alike_pairs(df, "id", "text", hot=3).collect()}
    want = {(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if (a := texts[i]) is not None and (b := texts[j]) is not None and canonical(a) and canonical(a) == canonical(b) and a.strip() != b.strip()}
    assert got == want and want
    assert look_alike_pairs(df.limit(0), "id", "text").count() == 0


def test_form_keeps_columns(spark):
    df = spark.createDataFrame([(1, "ｅ", "old"), (2, None, None)], "id int, text string, canonical string")
    got = {r.id: (r.text, r.canonical) for r in canonical_form(df, "text").collect()}
    assert got == {1: ("ｅ", "e"), 2: (None, None)}


def test_classes_against_pairs(spark):
    from groundset.llm.canon import look_alike_classes

    texts = ["abc", "abc", "\u0430bc", "a\u200bbc", "\u0430bc", "x y", "x\u00a0y", "z", "z", None, ""]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(0, "abc", 0)], "id long, text string, links int")
    pairs = {(r.id_a, r.id_b) for r in look_alike_pairs(df, "id", "text").collect()}
    got = {r.id: (r.class_id, r.links) for r in look_alike_classes(df, "id", "text").collect()}
    assert got == {i: (0 if i < 5 else 5, sum(i in p for p in pairs)) for i in {x for p in pairs for x in p}}
    assert got[0] == (0, 3) and got[3] == (0, 4) and got[5] == (5, 1) and 7 not in got
    assert look_alike_classes(df.limit(0), "id", "text").count() == 0
