import random

import pytest

from groundset.llm import leak as L
from groundset.llm import mix as X
from groundset.llm import residue as R


def naive(weights, seats, most):
    out = [0] * len(weights)
    for _ in range(seats):
        live = [i for i, w in enumerate(weights) if w > 0 and out[i] < most[i]]
        if not live:
            break
        i = max(live, key=lambda i: (weights[i] / (2 * out[i] + 1), -i))
        out[i] += 1
    return out


def test_apportionment_by_quotients():
    rng = random.Random(7)
    for _ in range(200):
        n = rng.randint(1, 8)
        w = [rng.choice([0, 1, 2, 5.5, rng.random() * 10]) for _ in range(n)]
        most = [rng.choice([0, 3, 50, 1000]) for _ in range(n)]
        seats = rng.randint(0, 300)
        assert X.sainte_lague(w, seats, most) == naive(w, seats, most)


def test_mixture(spark):
    rng = random.Random(8)
    rows = [(i, s, rng.randint(1, 60), 0) for i, s in enumerate(["a"] * 900 + ["b"] * 200 + ["c"] * 50)] + [(5000, None, 9, 0), (5001, "zz", 9, 0), (5002, "a", 0, 0), (None, "a", 5, 0)]
    sizes = spark.createDataFrame(rows, "doc_id long, source string, tokens long, copies int")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.1, 3), ("none", 0.1, 4), (None, 0.2, 1)], "source string, target_share double, max_repeats int")
    mix, _ = X.mixture(sizes, targets, block=64)
    got = mix.collect()
    total = sum(r.tokens * r.copies for r in got)
    for s, share, most in (("a", 5 / 9, 1), ("b", 3 / 9, 2), ("c", 1 / 9, 3)):
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.tokens * r.copies for r in mine) / total - share) < 0.02 and max(r.copies for r in mine) <= most
    assert {r.source for r in got} == {"a", "b", "c"} and len({r.doc_id for r in got}) == len(got)
    assert sorted(map(tuple, got)) == sorted(map(tuple, X.mixture(sizes.repartition(5), targets, block=64)[0].collect()))
    assert X.mixture(sizes.limit(0), targets)[0].count() == 0


def test_shards_place_all_blocks(spark, monkeypatch):
    rng = random.Random(9)
    for _ in range(200):
        supply, r = [rng.randint(1, 90) for _ in range(rng.randint(1, 9))], rng.randint(1, 4)
        total = rng.randint(0, sum(supply) * r)
        got = X.shard_quotas(total // 4, 4, supply, r)
        assert total - 4 - 3 * len(supply) <= sum(got) <= total and all(0 <= g <= s * r for g, s in zip(got, supply))
    monkeypatch.setattr(X, "ROWS_PER_SHARD", 20)
    sizes = spark.createDataFrame([(i, s, rng.randint(1, 60)) for i, s in enumerate(["a"] * 1500 + ["b"] * 100 + ["c"] * 10)], "doc_id long, source string, tokens long")
    targets = spark.createDataFrame([("a", 0.9, 3), ("b", 0.09, 2), ("c", 0.01, 3)], "source string, target_share double, max_repeats int")
    mix, blocks = X.mixture(sizes, targets, block=64)  # blocks no longer shrink with the input; 256 was cut to 62 here
    got = {s: sum(r.tokens * r.copies for r in mix.collect() if r.source == s) for s in "abc"}
    for s, shards in (("a", 75), ("b", 5), ("c", 1)):
        n, size = blocks[s]
        assert n and abs(got[s] - n * size) <= 30 * shards
        assert abs(got[s] / sum(got.values()) - {"a": 0.9, "b": 0.09, "c": 0.01}[s]) < 0.003
    assert all(r.copies <= {"a": 3, "b": 2, "c": 3}[r.source] for r in mix.collect())


def test_counts_of_runs_are_counts_of_the_whole(spark):
    text = "The reeve's 17 marks, noted.\n\nÄpfel und Öl  im Jahre 1588; " * 400
    df = spark.createDataFrame([(1, text, 3), (2, None, 3), (3, "", 3)], "doc_id long, text string, tokens int")
    a = {r.doc_id: r.tokens for r in X.count_tokens(df, "text", run_chars=500).collect()}
    assert a == {r.doc_id: r.tokens for r in X.count_tokens(df, "text").collect()} and a[2] == a[3] == 0 and a[1] == len(X.encoder(X.VOCABULARY).encode_ordinary(text))


PROSE = [f"The {a} of {b} {v} the old {o} near the ford, and the {a} paid {k} marks without any receipt." for a in ("reeve", "bailiff", "steward", "purser") for b in ("Torham", "Elwick", "Norford") for v in ("noted", "leased", "mended") for o in ("barn", "weir", "deed") for k in (3, 17)]
RESIDUE = ["Dear {{ user }}, welcome.", "Noted by $author$ in the year.", "Lorem ipsum dolor sit amet consectetur elit sed do.", "404 - page not found. Check the address.", "Bitte aktivieren Sie JavaScript, um die Seite zu sehen.", "Coming soon: record 12.", PROSE[0] + " " + PROSE[1] + " The reeve {{title}} the barn.", PROSE[2] + "\n\nIpsum nisi labore commodo tempor labore ullamco consequat lorem elit labore magna nisi."]
REAL = [PROSE[5] + " The viewer needs JavaScript, as Hamo explains in the guide, and the paper copy remains at Torham. " + PROSE[9], "The heading [sic] is torn: [...] of Elwick, and the clerk wrote [illegible] over the name. " + PROSE[3], 'The template reads "the text in {b}", where the braces stand for a box. ' + PROSE[7], "", None, "x"]


def test_residue(spark):
    talk = ["When the catalogue moved, the old link answered with a 404 page for 9 days, so Gunnora copied the list by hand.", 'The prompt template in the manual reads "write the text in {b}", where the braces stand for a sign.', "The note ends with [margin cut off] and the heading [sic] is torn: [...]; the clerk wrote [blank] over it."]
    model = R.Residue.fit(PROSE * 3 + talk * 6)
    kinds, _ = model.kinds(RESIDUE + REAL + PROSE)
    assert all(kinds[: len(RESIDUE)]), [t for t, k in zip(RESIDUE, kinds) if not k]
    assert not any(kinds[len(RESIDUE) :])
    long = " ".join(PROSE * 600)
    assert model.kinds([long])[0] == [None] and model.kinds([long + " {{ title }}"])[0] == ["placeholder"]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(RESIDUE + REAL)], "doc_id long, text string, residue string")
    got = R.flag_residue(df, "doc_id", "text", model)
    assert got.columns == ["doc_id", "residue", "residue_share"] and got.where("residue IS NOT NULL").count() == len(RESIDUE)
    assert R.flag_residue(df.limit(0), "doc_id", "text").count() == 0


def test_forms_are_written_out():
    rng = R.random.Random(1)
    for forms in (*R.NOTICE_FORMS.values(), *R.FILLER_FORMS.values()):
        for f in forms:
            for _ in range(5):
                out = R.written_out(f, rng)
                assert out and "|" not in out.replace(" | ", "") and "\x01" not in out and "{STATUS" not in out


@pytest.mark.parametrize("family", [*R.NOTICE_FORMS, *R.FILLER_FORMS])
def test_family_left_out_is_learned_from_the_corpus_or_near_forms(family):
    """Held-out forms: seed models without one family, on three texts of it."""
    model = R.Residue.fit(PROSE * 3, without=family)
    rng = R.random.Random(2)
    texts = [" ".join(R.written_out(f, rng) for _ in range(2)) for f in (R.NOTICE_FORMS | R.FILLER_FORMS)[family] for _ in range(6)]
    share = sum(k is not None for k in model.kinds(texts)[0]) / len(texts)
    assert share >= 0.9, share


def test_models_of_the_corpus(spark):
    new = ["Kindly reboot the gizmo portal and allow widgets. " * 2]  # nothing the seed forms have
    mixed = [f"Please enable JavaScript in your browser to view this page. {x}" for x in new for _ in range(4)]
    rows = list(enumerate(PROSE * 4 + mixed * 10 + new + [None, ""]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = R.learned(df, "doc_id", "text")
    assert not any(model.kinds(PROSE)[0]) and all(model.kinds(mixed)[0])
    assert R.learned(df.limit(0), "doc_id", "text").kinds(["x"])[0] == [None]


def test_seed_models_count_all_whole_texts(spark, monkeypatch):
    """More rows than 3,000, n-grams that stand only behind sign 6,000: both were outside the sample of prose."""
    long = " ".join(PROSE) + " Zwyxq vkjorq."
    texts = [f"{i} {PROSE[i % len(PROSE)][:30]}" for i in range(3100)] + [long] + ["Lorem ipsum dolor sit amet consectetur elit sed do."] * 40 + ["ab", "abc", "abcd", ""]
    bases, fitted = [], R.Residue.of_counts
    monkeypatch.setattr(R.Residue, "of_counts", lambda residue, base: bases.append(base) or fitted(residue, base))
    df = spark.createDataFrame([*enumerate(texts), (9999, None)], "doc_id long, text string")
    tables = R.learned(df, "doc_id", "text").tables

    def counts(kept):
        out = R.np.zeros(1 << R.BITS)
        for t in kept:
            R.np.add.at(out, R.grams(R.points(t))[: max(0, len(t) - R.ORDER + 1)], 1)
        return out

    assert (bases[0] == counts(texts)).all()
    first = fitted({k: [R._counts(v)] for k, v in R.training_residue().items()}, bases[0])
    kept = [t for t, kind in zip(texts, first.kinds(texts)[0]) if kind is None]
    assert long in kept and len(kept) == len(texts) - 40 and (bases[1] == counts(kept)).all()
    assert (R.learned(df.repartition(5), "doc_id", "text").tables == tables).all()


def test_prose_is_counted_once(spark, monkeypatch):
    """The passes with a model count the n-grams of what they call residue only; the prose of the models is that of the texts left."""
    other = R.training_residue(seed=6)["filler"][:9]
    texts = PROSE * 4 + other + ["ab", "", None]
    passes, counted, bases, fitted = [], R.corpus_counts, [], R.Residue.of_counts
    monkeypatch.setattr(R, "corpus_counts", lambda *a: passes.append(counted(*a)) or passes[-1])
    monkeypatch.setattr(R.Residue, "of_counts", lambda residue, base: bases.append(base) or fitted(residue, base))
    R.learned(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(3), "doc_id", "text")
    whole = lambda kept: R.np.bincount(R._inside([t for t in kept if t]), minlength=1 << R.BITS)
    assert len(passes) == 3 and (passes[0][0] == whole(texts)).all()
    assert all((p[0] == whole(other)).all() for p in passes[1:])
    assert len(bases) == 3 and (bases[0] == whole(texts)).all() and all((b == whole(PROSE * 4)).all() for b in bases[1:])


def test_windows_are_those_of_single_signs(monkeypatch):
    rng = R.np.random.default_rng(4)
    text = lambda n: "".join(rng.choice(list("abc éЖ1.{𐍈\n"), n))
    for thresholds in ((0.0, 1.1, 0.9), R.LEARNED_THRESHOLDS, (-9.0, 0.35, 9.0)):
        model = R.Residue(rng.integers(-127, 128, (3, 1 << R.BITS)).astype(R.np.int8), thresholds)
        for n in (1, 2, 5, 11, 12, 13, 23, 24, 25, 26, 90):
            h, one = R.grams(R.points(text(n))), R.np.array([0, n])
            got = model._hits(h, one[:1], one[1:], model._limits())
            for k, w in enumerate(R.WINDOWS):
                spans = [(max(0, i - w // 2), min(n, i + w // 2)) for i in range(n)]
                assert got[k].tolist() == [i for i, (a, b) in enumerate(spans) if model.tables[k][h[a:b]].sum(dtype=int) > thresholds[k] * R.SCALE * (b - a)]
    model = R.Residue.fit(PROSE * 3)
    mixed = [*RESIDUE, *REAL, *PROSE, " ".join(PROSE), *(text(n) for n in range(60))]
    want = model.kinds(mixed)
    for piece in (1, 7, 300, 1 << 20):
        monkeypatch.setattr(R, "PIECE", piece)
        assert model.kinds(mixed) == want


def test_scoring_needs_little_memory_a_sign():
    """Scoring works on small pieces; arrays over all signs of a group cost p10_found CPU time."""
    import tracemalloc

    model = R.Residue.fit(PROSE)
    texts = PROSE * 90
    model.kinds(texts[:9])
    tracemalloc.start()
    model.kinds(texts)
    peak = tracemalloc.get_traced_memory()[1] / min(1 << 20, sum(map(len, texts)))
    tracemalloc.stop()
    assert peak < 30, peak


def _items(rng, n, vocabulary, words):
    return [[rng.choice(vocabulary) for _ in range(words)] for _ in range(n)]


@pytest.mark.parametrize("vocabulary", [400, 150])
def test_leaks_against_brute_force(spark, vocabulary):
    rng = random.Random(9)
    v = [f"w{i}x" for i in range(vocabulary)]
    items = _items(rng, 12, v, 50) + [["short", "one", "here"], ["single"]]
    items.append(list(items[0]))
    docs = []
    for i in range(120):
        d = [rng.choice(v) for _ in range(80)]
        if i % 3 == 0:
            it = rng.choice(items[:12])
            a = rng.randint(0, 20)
            part = list(it[a : a + rng.choice([12, 19, 20, 25, 30])])
            for _ in range(i % 2):
                k = rng.randint(3, len(part) - 4)
                part[k : k + 1] = rng.choice([["zzz"], [], [part[k], "extra"]])
            d[30:30] = part
        if i % 40 == 1:
            d[5:5] = ["Short,", "ONE", "hére"]
        docs.append((i, " ".join(d), "c", 7))
    docs += [(1000, None, "c", 7), (1001, "", "c", 7), (None, " ".join(items[0]), "c", 7), (1002, "single", "c", 7)]
    df = spark.createDataFrame(docs, "doc_id long, text string, c string, item_id int")
    tests = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)] + [(99, None), (98, "..."), (None, "a b")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in L.find_leaks(df, "doc_id", "text", tests, "item_id", "text").collect()}
    want = set()
    for doc, text, _, _ in docs:
        if doc is None or not text:
            continue
        d = L.words(text)
        for i, w in enumerate(items):
            best = max((L.run_length(w, d, a, b) for b, x in enumerate(d) for a, y in enumerate(w) if x == y), default=0)
            if best >= min(L.RUN, len(w)):
                want.add((doc, i))
    assert got == want and len(want) > 20
    assert L.find_leaks(df, "doc_id", "text", tests.limit(0), "item_id", "text").count() == 0
    assert L.find_leaks(df.limit(0), "doc_id", "text", tests, "item_id", "text").count() == 0


def test_leaks_with_altered_words(spark):
    rng = random.Random(12)
    v = [f"w{i}x" for i in range(3000)]
    items = _items(rng, 30, v, 40)
    docs, want = [], set()
    for i, w in enumerate(items):
        for n in range(2, 6):
            part = list(w[9:29])
            for k in (3, 5, 7, 12, 14)[:n] if i % 2 else rng.sample([2, 4, 6, 9, 11, 13, 15, 17], n):  # single words, some with one intact word between them
                part[k] = "zzz"
            docs.append((len(docs), " ".join([rng.choice(v) for _ in range(50)] + part + [rng.choice(v) for _ in range(50)])))
            want.add((len(docs) - 1, i))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in L.find_leaks(df, "doc_id", "text", tests, "item_id", "text").collect()}
    assert want <= got and len(got - want) < 3


def test_run_lengths_are_those_of_single_runs():
    rng = random.Random(13)
    for _ in range(300):
        item, doc = ([rng.choice("abcde") for _ in range(rng.randint(1, 12))] for _ in range(2))
        places = [(i, j) for i, x in enumerate(item) for j, y in enumerate(doc) if x == y]
        row, text = ([e, e, *(ord(x) for x in t), e, e, *(ord(x) for x in t), e, e] for t, e in ((item, L.ITEM_END), (doc, L.DOC_END)))
        i, j = (L.np.array([p[k] + 2 for p in places], int) for k in (0, 1))
        assert L.run_lengths(L.np.array(row), L.np.array(text), i, j)[0].tolist() == [L.run_length(item, doc, a, b) for a, b in places]


def test_run_goes_on_at_one_agreeing_word():
    item = [f"w{i}x" for i in range(20)]
    for altered in ([5, 7], [4, 6, 11], [3, 5, 7, 12], [3, 5, 7, 12, 14]):
        doc = ["zzz" if i in altered else w for i, w in enumerate(item)]
        assert L.run_length(item, doc, 0, 0) == L.run_length(item, doc, 19, 19) == 20


def test_packed_numbers():
    v = L.np.array([0, 1, 127, 128, 16383, 16384, 2**40, 5], L.np.int64)
    assert L.unpacked(L.packed(v)[0]).tolist() == v.tolist() and L.packed(v[:0])[0].size == L.unpacked(L.np.array([], L.np.uint8)).size == 0


def test_one_index_for_several_test_sets(spark, tmp_path):
    docs = spark.createDataFrame([(1, "One two three, four five six.", "x"), (2, None, "x"), (3, "", "x"), (None, "one two", "x"), (4, "two one four five 6ix six", "x")], "doc_id long, text string, term string")
    index = L.write_index(docs, "doc_id", "text", str(tmp_path / "index"))
    assert index.where("term <> ''").agg({"n": "sum"}).first()[0] == 12
    ask = lambda *t: sorted(map(tuple, L.find_in_index(index, spark.createDataFrame(list(enumerate(t)), "item_id int, text string"), "item_id", "text").collect()))
    assert ask("four five six", "nine") == [(1, 0, 3, 3), (4, 0, 3, 3)]  # the second with a word between
    assert ask("Two three four") == [(1, 0, 3, 3)]
    assert ask("two three four five six") == [(1, 0, 5, 5), (4, 0, 5, 4)]  # the second with a word altered and one added
    assert ask("one two", "TWO ONE") == [(1, 0, 2, 2), (4, 1, 2, 2)]
    assert ask("...") == []


def test_words():
    assert L.words("The “Pärch-\n> ment”, of\nJuly!") == ["the", "parchment", "of", "july"]
    assert L.words("a​b é") == ["ab", "e"]
