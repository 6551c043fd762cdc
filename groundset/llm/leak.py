"""Problem 8: passages of held-out items inside a corpus.

A positional inverted index holds where every word of every text stands. It is built once
without a shuffle, stored, and asked for any set of test items: the postings of the items'
words are read, those of the rarest words of every stretch of RUN words of an item are
intersected with those of their neighbours, offsets taken off, and where they meet the lists
of the words around are compared. What agrees is a phrase or, with single words altered, a
proximity match.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundset.session import small_rows, small_side, table, written

RUN = 20
ANCHORS = 6  # pairs of words of a stretch; as they share no word, a run with fewer altered words keeps one
WAYS = ((1, 1), (1, 0), (0, 1), (1, 2), (2, 1))  # words of the item and of the document that an alteration takes up
ITEM_END, DOC_END = -3, -2
BLOCK_WORDS = 200_000
MEETINGS = 1 << 19  # of anchors and documents that are aligned at once
MAX_ITEMS = 200_000
MAX_BROADCAST_WORDS = 500_000  # of the test items; more are joined by shuffle
INDEX = "block long, term string, n int, places binary"
OUT = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("words", pa.int32()), ("agreeing", pa.int32())])
_WORD = re.compile(r"[^\W_]+")
_BREAK = re.compile(r"(?<=[^\W\d_])[-¬‐\u00ad⸗][ \t]*\n[ \t>]*(?=[^\W\d_])")
_UNDRAWN = re.compile("[\u00ad\u200b-\u200d\u2060\ufeff]")


def words(text: str) -> list[str]:
    """The words of a text without case, accents, punctuation and line breaks."""
    if "\n" in text:
        text = _BREAK.sub("", text)
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKD", _UNDRAWN.sub("", text))
        text = "".join(c for c in text if c < "\u0300" or not unicodedata.combining(c)) if not text.isascii() else text
    return _WORD.findall(text)


def run_length(item: list[str], doc: list[str], i: int, j: int) -> int:
    """Words of the item in a row that stand in the document around item[i] = doc[j].

    A word may be altered, missing, added, split or joined if the word next to it agrees; of
    several ways to go on, one after which two words agree comes first.
    """

    def agree(a: int, b: int, step: int, least: int) -> bool:
        n = 0
        while n < least and 0 <= a < len(item) and 0 <= b < len(doc):
            if item[a] != doc[b]:
                return False
            a, b, n = a + step, b + step, n + 1
        return n > 0

    def side(a: int, b: int, step: int) -> int:
        span = 0
        while 0 <= a < len(item) and 0 <= b < len(doc):
            if item[a] == doc[b]:
                a, b, span = a + step, b + step, span + 1
                continue
            way = next(((da, db) for least in (2, 1) for da, db in WAYS if agree(a + da * step, b + db * step, step, least)), None)
            if way is None:
                break
            a, b, span = a + way[0] * step, b + way[1] * step, span + way[0]
        return span

    return side(i, j, 1) + side(i - 1, j - 1, -1)


def run_lengths(items: np.ndarray, docs: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """run_length for many places at once, and how many of those words agree; words are numbers, texts are parted by two ends (ITEM_END, DOC_END)."""
    steps = np.array(WAYS)

    def side(a: np.ndarray, b: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        span, same, live = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64), np.arange(len(a))
        while len(live):
            x, y = items[a], docs[b]
            da = (x == y).astype(np.int64)
            db = da.copy()
            same[live] += da
            off = np.flatnonzero((x != y) & (x != ITEM_END) & (y != DOC_END))
            p, q = a[off], b[off]
            agrees = np.stack([items[p + wa * step] == docs[q + wb * step] for wa, wb in WAYS])
            some = np.flatnonzero(agrees.any(axis=0))
            off, p, q, agrees = off[some], p[some], q[some], agrees[:, some]
            twice = np.zeros_like(agrees)
            for k, (wa, wb) in enumerate(WAYS):
                x, y = items[p + (wa + agrees[k]) * step], docs[q + (wb + agrees[k]) * step]
                twice[k] = agrees[k] & ((x == y) | (x == ITEM_END) | (y == DOC_END))
            way = np.where(twice.any(axis=0), twice.argmax(axis=0), agrees.argmax(axis=0))
            da[off], db[off] = steps[way, 0], steps[way, 1]
            on = da > 0
            on |= db > 0
            live, a, b = live[on], (a + da * step)[on], (b + db * step)[on]
            span[live] += da[on]
        return span, same

    (after, more), (before, less) = side(i, j, 1), side(i - 1, j - 1, -1)
    return after + before, more + less


def pairs(w: list[str]) -> list[tuple[str, str]]:
    """The terms that are sought: words with the one behind them; a text of one word has that word as its term."""
    return list(zip(w, w[1:])) or [(x, "") for x in w]


def choose(items: dict[int, list], frequency: Callable[..., tuple | int], each: int, run: int = RUN) -> dict[int, list[int]]:
    """Positions of disjoint terms, the rarest ``each`` of every stretch of ``run`` words where there are so many.

    As chosen terms share no word, a run with e altered words keeps all but e of its terms.
    Of items shorter than a stretch all terms are chosen.
    """
    out: dict[int, list[int]] = {}
    for item, terms in items.items():
        if len(terms) < run - 1:
            out[item] = list(range(len(terms)))
            continue
        span = max(1, run - 1)
        need = [each] * max(1, len(terms) - span + 1)
        chosen: set[int] = set()
        for p in sorted(range(len(terms)), key=lambda p: (frequency(terms[p]), p)):
            if p - 1 in chosen or p + 1 in chosen:
                continue
            around = range(max(0, p - span + 1), min(len(need), p + 1))
            if any(need[a] > 0 for a in around):
                chosen.add(p)
                for a in around:
                    need[a] -= 1
        out[item] = sorted(chosen)
    return out


# --- the index -------------------------------------------------------------------------------


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers as bytes of seven bits, low ones first, and the number of bytes of each."""
    v = values.astype(np.uint64)
    size = np.ones(len(v), np.int64)
    for k in range(1, 10):
        size += v >= np.uint64(1 << 7 * k)
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(v) else 0, np.uint8)
    starts = ends - size
    for k in range(int(size.max()) if len(v) else 0):
        on = size > k
        part = (v[on] >> np.uint64(7 * k)) & np.uint64(127)
        out[starts[on] + k] = part.astype(np.uint8) | np.where(size[on] > k + 1, 128, 0).astype(np.uint8)
    return out, size


def unpacked(data: np.ndarray) -> np.ndarray:
    """The numbers of ``packed`` bytes."""
    last = np.flatnonzero(data < 128)
    starts = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    size = last - starts + 1
    out = np.zeros(len(last), np.int64)
    for k in range(int(size.max()) if len(last) else 0):
        on = size > k
        out[on] |= (data[starts[on] + k] & 127).astype(np.int64) << (7 * k)
    return out


def _groups(b: pa.RecordBatch) -> Iterator[tuple[list[int], list[list[str]]]]:
    """Keys and words of the texts of a batch, some BLOCK_WORDS words at a time; null ones are left out."""
    keys, texts, n = [], [], 0
    for key, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
        if key is not None and t is not None:
            keys.append(key)
            texts.append(words(t))
            n += len(texts[-1])
            if n >= BLOCK_WORDS:
                yield keys, texts
                keys, texts, n = [], [], 0
    if keys:
        yield keys, texts


def postings(block: int, keys: list[int], texts: list[list[str]]) -> pa.RecordBatch:
    """The rows of one block: for each term its places, as steps from one to the next, and under the term '' where which text starts.

    Texts stand one after the other with two places between them, so a place is that of a text too.
    """
    number: defaultdict[str, int] = defaultdict(count().__next__)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ids = np.fromiter((number[x] for w in texts for x in w), np.int64, int(sizes.sum()))
    starts = np.cumsum(sizes + 2) - sizes
    place = np.arange(len(ids)) + 2 * (np.repeat(np.arange(len(texts)), sizes) + 1)
    names = sorted(number)
    rank = np.empty(len(names), np.int64)
    rank[[number[x] for x in names]] = np.arange(len(names))
    ids = rank[ids]
    order = np.argsort(ids, kind="stable")
    ids, place = ids[order], place[order]
    first = np.ones(len(ids), bool)
    first[1:] = ids[1:] != ids[:-1]
    data, size = packed(np.where(first, place, place - np.concatenate([[0], place[:-1]])) if len(ids) else place)
    n = np.bincount(ids, minlength=len(names))
    at = np.flatnonzero(first)
    until = np.cumsum(np.add.reduceat(size, at) if len(at) else size)
    texts_row = np.concatenate([np.array(keys, np.int64), starts, [int(sizes.sum()) + 2 * len(texts) + 2]]).astype(np.int64).tobytes()
    offsets = np.concatenate([[0], [len(texts_row)], len(texts_row) + until]).astype(np.int64)
    places = pa.Array.from_buffers(pa.large_binary(), len(names) + 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(texts_row + data.tobytes())]).cast(pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(names) + 1, block, np.int64)), pa.array(["", *names]), pa.array(np.concatenate([[len(keys)], n]).astype(np.int32)), places], ["block", "term", "n", "places"])


def index_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(block, term, n, places): the positional inverted index of all words of all texts.

    It is parted by documents: each task indexes its own texts in blocks of some BLOCK_WORDS
    words, so nothing is shuffled; a longer text is a block of its own. Null keys and texts
    are left out, an empty text has no word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32  # type: ignore[union-attr]
        for b in batches:
            for keys, texts in _groups(b):
                yield postings(block, keys, texts)
                block += 1

    return docs.select(F.col(key).cast("long"), text).mapInArrow(run, INDEX)


def write_index(docs: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """Store the index in a shared folder, to be asked for any number of test sets without the texts."""
    index_rows(docs, key, text).write.mode("errorifexists").parquet(path)
    return docs.sparkSession.read.schema(INDEX).parquet(path)


def block_numbers(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys of the texts, where they start, words by place) of a block's rows with the number w of each term; -1: a word that isn't asked for."""
    t = t.sort_by("w")
    w, n, held = (t.column(c).to_numpy() for c in ("w", "n", "places"))
    head = np.frombuffer(held[0], np.int64)  # w = -1: the texts
    keys, starts, total = head[: n[0]], head[n[0] : -1], int(head[-1])
    n, w = n[1:].astype(np.int64), w[1:].astype(np.int64)
    numbers = np.full(total, -1, np.int64)
    numbers[starts - 1] = numbers[starts - 2] = numbers[-2:] = DOC_END
    sums = np.cumsum(unpacked(np.frombuffer(b"".join(held[1:]), np.uint8)))
    numbers[sums - np.repeat(np.concatenate([[0], sums[np.cumsum(n)[:-1] - 1]]) if len(n) else n, n)] = np.repeat(w, n)
    return keys, starts, numbers


def meetings(numbers: np.ndarray, terms: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, which term): the list of the first word of each term, intersected with that of the second word with one taken off."""
    met = [np.where((numbers[:-1] >= 0) & (numbers[1:] >= 0), numbers[:-1] * size + numbers[1:], -1)]
    if (terms % size == size - 1).any():
        met.append(np.where(numbers >= 0, numbers * size + size - 1, -1))
    where, which = [], []
    for code in met:
        near = np.minimum(np.searchsorted(terms, code), len(terms) - 1)
        on = np.flatnonzero(terms[near] == code)
        where.append(on)
        which.append(near[on])
    return np.concatenate(where), np.concatenate(which)


def find_in_index(index: DataFrame, tests: DataFrame, item: str, passage: str, run: int = RUN) -> DataFrame:
    """(doc_id, item_id, words, agreeing): texts that hold at least ``run`` words of an item in a row, or all of a shorter one.

    A phrase match has ``agreeing`` = ``words``; in a proximity match single words are altered,
    missing or added. Null and empty texts on either side match nothing; repeated documents
    and items are all reported, a pair once. The items must be a stated query set of at most
    MAX_ITEMS rows. Only postings of the items' words are read; which terms are rarest, their
    counts in the whole index tell.
    """
    spark = index.sparkSession
    rows = small_rows(tests.where(F.col(item).isNotNull() & F.col(passage).isNotNull()).select(F.col(item).cast("long").alias("i"), F.col(passage).alias("t")), MAX_ITEMS, "the test items")
    items = {r["i"]: w for r in rows if (w := words(r["t"]))}
    schema = "doc_id long, item_id long, words int, agreeing int"
    if not items:
        return spark.createDataFrame([], schema)
    vocabulary = {x: n for n, x in enumerate(sorted({x for w in items.values() for x in w}))}
    asked = small_side(spark.createDataFrame(pa.table({"term": ["", *vocabulary], "w": pa.array([-1, *vocabulary.values()], pa.int32())})), len(vocabulary), MAX_BROADCAST_WORDS)
    held = index.join(asked, "term")
    size = len(vocabulary) + 1  # a term as one number; the second word of a term of one word is the number behind the last word
    number = lambda t: vocabulary[t[0]] * size + (vocabulary[t[1]] if t[1] else size - 1)
    terms = {i: pairs(w) for i, w in items.items()}
    sought = spark.sparkContext.broadcast(np.array(sorted({number(t) for ts in terms.values() for t in ts}), np.int64))  # the query set

    def counted(t: pa.Table) -> pa.Table:
        n = np.bincount(meetings(block_numbers(t)[2], sought.value, size)[1], minlength=len(sought.value))
        some = np.flatnonzero(n)
        return pa.table({"term": sought.value[some], "n": n[some]}, schema=pa.schema([("term", pa.int64()), ("n", pa.int64())]))

    counts = {r["term"]: r["n"] for r in held.groupBy("block").applyInArrow(counted, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}  # at most one row a term of the query set
    anchors = choose(terms, lambda t: counts.get(number(t), 0), ANCHORS, run)

    # the items as one row of numbers between ends, and for each anchor, as one number, the places where it stands in them
    row, owner, need, at = [ITEM_END, ITEM_END], [-1, -1], [], {}
    for n, (i, w) in enumerate(items.items()):
        for p in anchors[i]:
            at.setdefault(number(terms[i][p]), []).append(len(row) + p)
        row += [vocabulary[x] for x in w] + [ITEM_END, ITEM_END]
        owner += [n] * (len(w) + 2)
        need.append(min(run, len(w)))
    codes = sorted(at)
    arrays = (np.array(row, np.int64), np.array(owner, np.int64), np.array(need, np.int64), np.array(list(items), np.int64), np.array(codes, np.int64), np.cumsum([0, *(len(at[c]) for c in codes)]), np.array([p for c in codes for p in at[c]], np.int64))
    shared = spark.sparkContext.broadcast(arrays)  # the query set

    def align(t: pa.Table) -> pa.Table:
        row, owner, need, ids, codes, first, anchor_at = shared.value
        keys, starts, numbers = block_numbers(t)
        where, term = meetings(numbers, codes, size)
        many = first[term + 1] - first[term]
        found = [pa.table([[], [], [], []], schema=OUT)]
        part_of = np.cumsum(many) // MEETINGS
        for part in np.split(np.arange(len(where)), np.flatnonzero(np.diff(part_of)) + 1):
            k = many[part]
            j = np.repeat(where[part], k)
            i = anchor_at[np.arange(len(j)) - np.repeat(np.cumsum(k) - k, k) + np.repeat(first[term[part]], k)]
            length, same = run_lengths(row, numbers, i, j)
            ok = np.flatnonzero(length >= need[owner[i]])
            if len(ok):
                doc = np.searchsorted(starts, j[ok], side="right") - 1
                found.append(pa.table([pa.array(keys[doc]), pa.array(ids[owner[i[ok]]]), pa.array(length[ok].astype(np.int32)), pa.array(same[ok].astype(np.int32))], schema=OUT))
        return pa.concat_tables(found)

    runs = held.groupBy("block").applyInArrow(align, schema)
    best = runs.groupBy("doc_id", "item_id").agg(F.max(F.struct("words", "agreeing")).alias("b"))
    return best.select("doc_id", "item_id", "b.*")


def find_leaks(docs: DataFrame, key: str, text: str, tests: DataFrame, item: str, passage: str, run: int = RUN) -> DataFrame:
    """find_in_index over an index written for this one question."""
    return find_in_index(written(index_rows(docs, key, text), "postings"), tests, item, passage, run)


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_passages"), "item_id", "text")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir).select("doc_id", "item_id")


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaked items by suite, with the documents that hold them, those that hold a phrase of them unaltered, and the longest run."""
    leaks = _leaks(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("documents"), F.count_if(F.col("agreeing") == F.col("words")).alias("phrases"), F.max("words").alias("words"))
    return table(spark, sf_dir, "eval_passages").select("item_id", "suite", "lang").join(leaks, "item_id")


QUERIES = {"p8_found": p8_found, "p8_report": p8_report}
