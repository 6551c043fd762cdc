import random

import pytest

from groundset.llm import scan as S

WORDS = "the reeve steward bailiff counted mended leased exchanged surrendered pledged causeway inventory parchment boundary stone orchard granary receipt without presence witnesses harbour master vessel according custom consent through agent shillings marks value order tannery chapel beside behind river meadow account book smaller upper heavy faded missing disputed customary yearly winter second third quarter market village northern southern garden saddle barrel herring cartload charter copy kitchen window"
VOCABULARY = WORDS.split()
PLACES = ["Pemstow", "Torlawick", "Wendenford", "Elsmoham", "Norriton", "Garsterley"]
TITLES = ["Rolls of the Manor of", "Letters sent from", "Register of the Court at"]
EQUIVS = "equiv_id long, volume string, doc_id string, region_id string, line_id string, equiv_index int, unicode string, extra string"
REGIONS = "volume string, doc_id string, region_id string, region_no int, lines array<struct<idx:int,line_id:string,text:string>>"


def corpus(seed=1, pages=24):
    """(equivs, texts, truth): volumes of pages with noise put in at known lines."""
    rng = random.Random(seed)
    equivs, texts, truth, n = [], [], set(), 0
    for v, place in enumerate(PLACES):
        body: list[tuple[str, str]] = []  # lines with the kinds they show

        def wrapped(k):
            out = []
            for _ in range(k):
                words = [rng.choice(VOCABULARY) for _ in range(7)]
                kinds = ""
                if rng.random() < 0.08:
                    p = rng.randint(1, 5)
                    long = [w for w in VOCABULARY if len(w) > 5]
                    w = rng.choice(long)
                    noisy, gold = S.corrupt(w, rng)
                    if gold and noisy not in VOCABULARY:
                        words[p], kinds = noisy, "m"
                out.append((words, kinds))
            return out

        lines = wrapped(pages * 9)
        for k in range(len(lines) - 1):
            words, kinds = lines[k]
            if rng.random() < 0.06:
                w = rng.choice([x for x in VOCABULARY if len(x) > 6])
                words.append(w[:3] + rng.choice("-¬⸗"))
                lines[k + 1][0].insert(0, w[3:])
                kinds += "h"
            elif rng.random() < 0.05:
                words.insert(3, "market-garden")
            body.append((" ".join(words), kinds))
        body.append((" ".join(lines[-1][0]), lines[-1][1]))
        for p in range(pages):
            doc = f"v{v}_{p:04d}"
            head = f"{TITLES[v % 3]} {place}, 17{v}4" if p % 2 else f"{place.upper()} 17{v}4"
            page = [("1", head, "r")] + [("2", t, k) for t, k in body[p * 9 : p * 9 + 5]] + [("3", t, k) for t, k in body[p * 9 + 5 : p * 9 + 9]] + [("4", rng.choice(("- {} -", "[{}]", "{}", "fol. {}r")).format(p + 1), "n")]
            for at, (region, t, kinds) in enumerate(page):
                n += 1
                line = sum(r == region for r, _, _ in page[:at]) + 1
                equivs.append((n, f"v{v}", doc, f"r{region}", f"r{region}l{line}", 0, t, "x"))
                truth |= {(str(n), {"m": "misread", "h": "hyphen_break", "r": "running_head", "n": "page_number"}[k]) for k in kinds}
            if p < 4:
                texts.append((1000 * v + p, "\n".join(t for _, t, _ in page)))
    return equivs, texts, truth


def lines_of(spark, equivs, texts=(), regions=()):
    pages = S.page_lines(spark.createDataFrame(list(equivs), EQUIVS), spark.createDataFrame(list(regions), REGIONS))
    return pages.unionByName(S.text_lines(spark.createDataFrame(list(texts), "record_id long, completion string"), "record_id", "completion", "SFT.completion"))


@pytest.fixture(scope="module")
def judged(spark):
    equivs, texts, truth = corpus()
    scan = S.Scan(lines_of(spark, equivs + equivs[:20], texts))
    return scan, truth, {(r.field, r.row_key, r.kind) for r in scan.kinds().collect()}


def test_kinds_of_pages(judged):
    _, truth, got = judged
    found = {(k, kind) for f, k, kind in got if f == "TextEquiv.Unicode"}
    for kind, least in (("running_head", 0.97), ("page_number", 0.97), ("hyphen_break", 0.95), ("misread", 0.85)):
        t, g = ({x for x in s if x[1] == kind} for s in (truth, found))
        assert len(t & g) >= least * len(t) and len(t & g) >= 0.95 * len(g), (kind, len(t), len(g), len(t & g))


def test_kinds_of_texts(judged):
    scan, _, got = judged
    heads = {k for f, k, kind in got if f == "SFT.completion" and kind == "running_head"}
    numbers = {k for f, k, kind in got if f == "SFT.completion" and kind == "page_number"}
    text = "the reeve mended the barn\nthe steward leased it\n\nthe second order\nof the court"
    assert [r.repaired for r in S.Scan(lines_of(scan.lines.sparkSession, [], [(1, text)])).repaired().collect()] == ["the reeve mended the barn the steward leased it\n\nthe second order of the court"]
    assert len(heads) >= 23 and len(numbers) >= 23  # of 24 texts


def test_unfitted_models_find_nothing(judged, spark):
    scan, _, _ = judged
    assert scan.words.misread(S.Editor({})).count() == 0 and scan.words.misread().count() > 20
    none = S.Perceptron({})
    assert scan.placed().where((S.furniture_column(none) > 0) | (S.join_column(none, S.F.lit("-"), S.F.lit(0), S.F.lit(1)) > 0)).count() == 0


def test_repaired_texts(judged):
    scan, _, _ = judged
    pages = {(r.field, r.doc_id): r.repaired for r in scan.repaired().collect()}
    one = pages["TextEquiv.Unicode", "v0_0001"]
    assert "Rolls of the Manor" not in one and "\n" not in one and len(one.split()) > 50
    words = [w for d, t in pages.items() if d[0] == "TextEquiv.Unicode" for w in t.replace("market-garden", "").split()]
    assert sum(w in VOCABULARY for w in words) > 0.97 * len(words)


def test_editor_on_held_out_noise(judged, spark):
    scan, _, _ = judged
    rng = random.Random(2)
    counts = {r.low: r.n for r in scan.words.counts.collect()}
    right = n = 0
    for w in VOCABULARY * 3:
        noisy, gold = S.corrupt(w, rng)
        if len(w) > 4 and gold and noisy not in VOCABULARY:
            n += 1
            right += scan.words.editor.correction(noisy, max(1, counts.get(noisy, 0)), counts, scan.words.total) == w
    kept = [w for w in VOCABULARY if scan.words.editor.correction(w, counts[w], counts, scan.words.total) is None]
    assert right / n > 0.9 and len(kept) >= len(VOCABULARY) - 2


def test_operations():
    assert S.operations("d", "cl") == ["replace c d", "delete l"] and S.operations("in", "m") == ["replace m i", "insert n"] and S.operations("e", "c") == ["replace c e"]
    rng = random.Random(3)
    for w in VOCABULARY * 3:
        noisy, gold = S.corrupt(w, rng)
        if gold:
            assert w in [e[1] for e in S.edits(noisy, True) if e[0] == gold]


def test_numbers(spark):
    good = ("12", "[12]", "- 4l -", "— 23.", "·7·", "fol. 12v", "Pag. 9O", "xviii", "xix", "XL")
    bad = ("the", "12 marks", "", "in 12", "mild weather", "fol. of 12")
    df = spark.createDataFrame([(t,) for t in good + bad], "t string")
    assert {r.t for r in df.where(S.is_number(df.t)).collect()} == set(good)


def test_own_hyphens_and_edges_of_pages(spark):
    equivs, _, _ = corpus(2, 6)
    n = len(equivs)
    more = [("a_0063", "r2", 1, "the steward counted the sad-"), ("a_0064", "r1", 1, "dle and the bailiff leased two-"), ("a_0064", "r1", 2, "and three-year orders of the cus¬"), ("a_0065", "r1", 1, "tom without receipt"), ("a_0065", "r1", 2, "the order -"), ("a_0065", "r1", 3, "the last line of the vol-")]
    own = [("b_0001", "r1", k, "for two- and three-year leases of two-year barrels") for k in range(1, 9)]
    equivs += [(n + 1 + k, "w", d, r, f"{r}l{i}", 0, t, None) for k, (d, r, i, t) in enumerate(more + own)]
    got = {(r.row_key, r.kind) for r in S.Scan(lines_of(spark, equivs)).kinds().where("kind = 'hyphen_break'").collect()}
    assert {int(k) - n for k, _ in got if int(k) > n} == {1, 3}


def test_transcripts(spark):
    pages = ["[59]  Letters sent from Elwick.\nThe reeve", "[sic] the reeve\nthe chapel", "{torn} the reeve\nthe chapel", "<the reeve\nthe chapel>", '["the reeve" he said\nthe chapel']
    other = ["[[1, 2, 3, 4],\n [5, 6, 7, 8]]", "[1, 2,\n3, 4]", '[\n{"a": 1}]', '["a",\n"b"]', '{"a":\n1}', "<text>\na</text>", '<text lang="de">\na</text>', "<br/>\na", "<!-- a\n-->", "[\n]", "one line", "\n", "a\n\n", None]
    df = spark.createDataFrame(list(enumerate(pages + other)) + [(None, "a\nb")], "k long, t string")
    t = S.text_lines(df, "k", "t", "F")
    assert {r.row_key for r in t.collect()} == {str(k) for k in range(len(pages))}
    rows = {(r.line, r.edge) for r in S.text_lines(spark.createDataFrame([(1, "a b\nc d\n\ne f\n12\ng h")], "k long, t string"), "k", "t", "F").collect()}
    assert rows == {(0, True), (1, False), (3, True), (4, False), (5, True)}


def test_tables(spark):
    e = spark.createDataFrame([(1, "v", "d", "r1", "r1l1", 0, "  ", "c"), (2, "v", "d", "region_001", "x", None, "the reeve", "c"), (3, None, None, None, None, None, None, None)], "equiv_id long, volume string, doc_id string, region_id string, line_id string, equiv_index int, unicode string, text string")
    r = spark.createDataFrame([("v", "d", "r1", 0, None), ("v", "d", "r2", 1, [(0, "a", "text"), None, (1, "b", None)])], REGIONS)
    got = {(x.field, x.row_key, x.region) for x in S.page_lines(e, r).collect()}
    assert got == {("TextEquiv.Unicode", "2", 1), ("TextLineData.text", "d/r2/0", 1)}
    empty = S.Scan(lines_of(spark, []))
    assert empty.kinds().count() == 0 and empty.repaired().count() == 0
    long = S.Scan(lines_of(spark, [], [(1, "the reeve mended\n" * 20_000), (2, None)]))
    assert long.kinds().count() == 0 and len(long.repaired().first().repaired) > 300_000
