import bisect
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from groundset.llm import pack as P
from groundset.llm import split as S


def plain(sizes, capacity):
    """Best fit decreasing, one item after the other: the multiset of fills."""
    rests: list[int] = []
    for s in sorted(sizes, reverse=True):
        k = bisect.bisect_left(rests, s)
        r = rests.pop(k) if k < len(rests) else capacity
        bisect.insort(rests, r - s)
    return Counter(capacity - r for r in rests)


def test_same_as_one_by_one():
    rng = random.Random(4)
    for _ in range(150):
        cap = rng.randint(1, 40)
        sizes = [rng.randint(0, cap) for _ in range(rng.randint(0, 120))]
        fills: Counter = Counter()
        seen: Counter = Counter()
        for size, a, b, per, first, offset in P.best_fit_decreasing(Counter(sizes).items(), cap):
            for rank in range(a, b):
                c = first + (rank - a) // per
                assert fills[c] == offset + (rank - a) % per * size
                fills[c] += size
                seen[size] += 1
        assert seen == Counter(sizes)
        assert max(fills.values(), default=0) <= cap
        if 0 not in sizes:  # an item of no size may go to any container
            assert Counter(fills.values()) == plain(sizes, cap)


def test_tree_finds_the_tightest():
    rng = random.Random(5)
    t, have = P.RestTree(50), Counter()
    for _ in range(400):
        if rng.random() < 0.6:
            r = rng.randint(0, 50)
            t.add(r, 0, 1)
            have[r] += 1
        s = rng.randint(0, 50)
        want = min((r for r, n in have.items() if n and r >= s), default=-1)
        assert t.tightest(s) == want
        if want >= 0 and rng.random() < 0.7:
            t.take(want)
            have[want] -= 1


def test_pack_table(spark):
    rng = random.Random(6)
    rows = [(1, i, rng.randint(0, 30), 10, 0, 0) for i in range(400)] + [(2, i, 7, 10, 0, 0) for i in range(300)] + [(3, 1, 20, 10, 0, 0), (3, 2, None, 10, 0, 0), (4, None, 5, 10, 0, 0), (None, 5, 5, 10, 0, 0), (5, 1, 3, 0, 0, 0)]
    df = spark.createDataFrame(rows, "group_id int, item_id long, size int, capacity int, rank int, salt int")
    got = P.pack(df).collect()
    used: Counter = Counter()
    pieces: dict = {}
    for r in got:
        used[(r.group_id, r.container)] += r["size"]
        pieces.setdefault((r.group_id, r.item_id), []).append((r.piece_no, r["size"]))
    assert max(used.values()) <= 10
    for g, i, s, c, _, _ in rows:
        if g in (1, 2, 3) and i is not None:
            ps = sorted(pieces[(g, i)])
            assert sum(x for _, x in ps) == (s or 0) and [k for k, _ in ps] == list(range(len(ps)))
            assert len(ps) == max(1, -(-(s or 0) // c))
    assert not {g for g, _ in pieces} & {4, 5, None}
    assert len({c for g, c in used if g == 2}) == 300
    assert P.pack(df.limit(0)).count() == 0


TEXTS = [None, "", "a", "word " * 300, "x" * 1000, "One. Two!\n\nThree; four, five.\n" * 60, "🙂é" * 400, "é" * 500, "<a>b</a>" * 200, "\n" * 500, " " * 333]


@pytest.mark.parametrize("limit,overlap", [(1, 0), (2, 1), (7, 3), (50, 0), (50, 10), (50, 40), (50, 49), (50, 99), (400, 64), (5000, 0)])
def test_pieces(spark, limit, overlap):
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(TEXTS)], "id int, text string, pieces string")
    o = min(overlap, limit - 1)
    for r in S.pieces(df, "text", limit, overlap).collect():
        if r.text is None:
            assert r.pieces is None
            continue
        assert all(0 < len(p) <= limit for p in r.pieces)
        assert "".join([p if k == 0 else p[o:] for k, p in enumerate(r.pieces)]) == r.text
        assert all(a[len(a) - o :] == b[:o] for a, b in zip(r.pieces, r.pieces[1:]))
        assert len(r.pieces) == (0 if not r.text else 1) if len(r.text) <= limit else len(r.pieces) > 1


def test_natural_boundaries(spark):
    df = spark.createDataFrame([("Aaa bbb. Ccc ddd.\n\nEee fff ggg hhh iii jjj.",), ("aaaa bbbb cccc dddd",)], "t string")
    got = [r.pieces for r in S.pieces(df, "t", 20).collect()]
    assert got[0][0] == "Aaa bbb. Ccc ddd.\n\n" and got[1] == ["aaaa bbbb cccc dddd"]
    assert S.pieces(df, "t", 10).collect()[1].pieces == ["aaaa bbbb ", "cccc dddd"]
    with pytest.raises(ValueError):
        S.pieces(df, "t", 0)


def test_very_long_text(spark):
    df = spark.range(1).select(F.repeat(F.lit("word and word. "), 60_000).alias("t"))
    r = S.pieces(df, "t", 1000, 100).select(F.size("pieces"), F.array_max(F.transform("pieces", F.length))).collect()[0]
    assert r[0] >= 900 and r[1] <= 1000


def test_records(spark):
    df = spark.createDataFrame([(1, "a", "x" * 30, 9), (2, "a", "short", 9), (3, "b", "y" * 30, 9), (4, "a", None, 9), (1, "a", "x" * 30, 8)], "record_id long, data_path string, completion string, config_id int")
    got = S.split_records(df, [(1, "a", 10, 2), (2, "a", 25, 0)]).select("config_id", "record_id").distinct().collect()
    assert sorted(map(tuple, got)) == [(1, 1), (2, 1)]
    assert S.split_records(df, []).count() == 0
