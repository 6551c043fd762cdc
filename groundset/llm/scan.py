"""Problem 4: repair text from scanned pages.

Averaged perceptrons judge everything: an editor of characters (keep, replace, delete,
insert) with contexts and word counts as features, the join of a line with the next one, and
page furniture by shape and place on the page. They are fitted here, on noise put into words
and lines of the corpus; what an unfitted one is asked stays as it is.

Python works on distinct words only. Their counts stay distributed: every word meets the
counts of the words its edits lead to by a join, the editor scores it, and what it calls
misread is joined back to the lines. Lines are judged by column expressions made of the
perceptrons' weights.
"""

from __future__ import annotations

import random
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from groundset.functions.text import strip
from groundset.llm.canon import transducer
from groundset.session import checkpointed, small_side, table, written

#: What a scanner reads (second) for what is printed (first).
CONFUSIONS = (
    ("e", "c"), ("r", "v"), ("a", "o"), ("n", "u"), ("u", "n"), ("c", "e"), ("s", "f"), ("h", "b"), ("i", "!"), ("i", "1"), ("l", "1"), ("t", "+"), ("s", "5"), ("o", "0"), ("g", "9"), ("b", "6"),
    ("d", "cl"), ("m", "rn"), ("w", "vv"), ("in", "m"), ("ri", "n"), ("li", "h"), ("rn", "m"), ("cl", "d"), ("R", "K"), ("E", "F"), ("I", "1"), ("O", "0"), ("B", "6"), ("S", "5"), ("G", "9"), ("L", "1"), ("T", "+"), ("I", "!"),
)
SEEN: dict[str, list[int]] = defaultdict(list)
for _n, (_true, _seen) in enumerate(CONFUSIONS):
    SEEN[_seen[0]].append(_n)
HYPHENS = "-‐‑¬⸗=­"
SAMPLE_WORDS = 2000  # words that stand often, drawn by hash, which the editor is fitted on; so are
SAMPLE_NAMES = 1000  # capitalised words that stand once or twice
SAMPLE_PAGES = 300  # pages, drawn by hash, whose lines the judge of furniture is fitted on
SAMPLE_LINES = 8_000  # of these pages at most, by hash
SAMPLE_COMPOUNDS = 2000
KEY = ["field", "doc_id", "row_key", "at"]  # of a line
OFTEN = 3  # a word that stands so often can be what a misread one should be
RARE = 1e-5  # of all words: only rarer ones are tried for two misread places
BLOCK_PAGES = 64
HEAD_SHARE = 0.1  # of the pages of a volume that must begin with a wording or place name for it to be part of a title
HEAD_WORDS = 9  # longer lines aren't compared with the heads of other pages
NEAR_PAGES = 8  # page numbers over the edge of a block in which the next and previous page are looked for
MAX_BROADCAST_WORDS = 100_000  # larger tables of words are joined by shuffle
#: How JSON, lists of boxes and markup start, for Spark: a list of lists, numbers, objects or strings, an object, a tag, comment or declaration.
NO_TRANSCRIPT = r"""^\s*(?:\[\s*(?:\[\s*)*(?:-?[\d.]+\s*,|\{\s*["}]|"[^"]*"\s*[,\]]|\]\s*(?:,|\]|$))|\{\s*(?:"[^"]*"\s*:|\}\s*$)|</?[A-Za-z][\w:.-]*(?:\s*/?>|\s+[\w:.-]+\s*=)|<[!?])"""
_L = r"[\p{L}\p{M}\p{N}]++"
WORD = rf"[+!]?{_L}(?:[+!]{_L})*+(?:['’-]{_L}(?:[+!]{_L})*+)*+\+?"
INSIDE = r"\p{L}[\d+!]\p{L}"
UNDRAWN = r"[​-‍⁠﻿]|­(?=.)"
NUMBER = r"^[\[(\-—–·\s]*(?:(?i:fol|pag|p|s|bl|f)\.?\s*)?(?:(?=[^\d]*\d)[\dlIOo!S]{1,4}|[lI])\s*[rv]?[\])\-—–·.\s]*$|^[\[(\-—–·\s]*(?=[ivxlcdmIVXLCDM1!])[ivxlcdm1!]{1,80}[\])\-—–·.\s]*$|^[\[(\-—–·\s]*[IVXLCDM1]{1,15}[\])\-—–·.\s]*$"
EDGE = r"(?i)^(?:[\[(\-—–·]\s*[\dlIOo!ivxlcdm]+\s*[\])\-—–·.]*|(?:fol|pag|p|s|bl)\.?\s*[\dlIOo!]+[rv]?|[\dlIOo]*\d[\dlIOo]*[.]?|[ivxlcdm]+)\s{2,}|\s{2,}(?:[\[(\-—–·]\s*[\dlIOo!ivxlcdm]+\s*[\])\-—–·.]*|(?:fol|pag|p|s|bl)\.?\s*[\dlIOo!]+[rv]?|[\dlIOo]*\d[\dlIOo]*[.]?|[ivxlcdm]+)$"
_MIXED = re.compile(r"[^\W\d_][\d+!]|[\d+!][^\W\d_]")
_ORDINAL = re.compile(r"^\d+(?:st|nd|rd|th|e|er|re|a|r|v|o)?$|^[rpf]\d+$", re.I)


class Perceptron:
    """Weights of features; a score above 0 means yes."""

    def __init__(self, weights: dict[str, float] | None = None) -> None:
        self.w = weights or {}

    def score(self, features: Iterable[str]) -> float:
        get = self.w.get
        return sum(get(f, 0.0) for f in features)

    @classmethod
    def fit(cls, examples: list[tuple[list[str], int]], rounds: int = 3, seed: int = 3, margin: float = 0.5) -> Perceptron:
        """The average of the weights over all steps, from (features, 1 or -1)."""
        rng = random.Random(seed)
        w: dict[str, float] = defaultdict(float)
        total: dict[str, float] = defaultdict(float)
        shown, step = list(examples), 1
        for _ in range(rounds):
            rng.shuffle(shown)
            for features, want in shown:
                if sum(w[f] for f in features) * want <= margin:
                    for f in features:
                        w[f] += want
                        total[f] += want * step
                step += 1
        return cls({k: round(v - total[k] / step, 4) for k, v in w.items() if v or total[k]})


# --- the editor of characters ----------------------------------------------------------------

Edit = tuple[tuple[tuple[int, int], ...], str]  # places with their confusions, and the word they make


def operations(true: str, seen: str) -> list[str]:
    """A confusion as operations on single characters of what was seen."""
    out = []
    for i in range(max(len(true), len(seen))):
        a, b = seen[i : i + 1], true[i : i + 1]
        out.append(f"insert {b}" if not a else f"delete {a}" if not b else f"replace {a} {b}" if a != b else "keep")
    return out


_OPERATIONS = [operations(*c) for c in CONFUSIONS]


def single_edits(word: str) -> list[Edit]:
    """All ways to undo one confusion."""
    return [(((p, n),), word[:p] + CONFUSIONS[n][0] + word[p + len(CONFUSIONS[n][1]) :]) for p in range(len(word)) for n in SEEN.get(word[p], ()) if word.startswith(CONFUSIONS[n][1], p)]


def edits(word: str, twice: bool) -> list[Edit]:
    """Single edits, and pairs of such at places that don't touch."""
    one = single_edits(word)
    if not twice:
        return one
    two = []
    for i, (((p, n),), _) in enumerate(one):
        for ((q, m),), _ in one[i + 1 :]:
            if q >= p + len(CONFUSIONS[n][1]):
                two.append((((p, n), (q, m)), word[:p] + CONFUSIONS[n][0] + word[p + len(CONFUSIONS[n][1]) : q] + CONFUSIONS[m][0] + word[q + len(CONFUSIONS[m][1]) :]))
    return one + two


def shape(word: str) -> str:
    return "m" if _MIXED.search(word) else "l" if word.islower() else "U" if word.isupper() else "C"


def edit_features(word: str, edit: Edit, own: int, to: int, total: int) -> list[str]:
    """Contexts of each place, the operations, and how often the word and what it would become stand among ``total`` words."""
    out = ["twice" if len(edit[0]) > 1 else "once"]
    s = f"\x02\x02\x02{word}\x03\x03\x03"
    for p, n in edit[0]:
        a, b = p + 3, p + 3 + len(CONFUSIONS[n][1])
        out += [f"{n}", f"{n}a{s[a - 1 : b + 1]}", f"{n}b{s[a - 2 : b]}", f"{n}c{s[a : b + 2]}", f"{n}d{s[a - 2 : b + 1]}", f"{n}e{s[a - 1 : b + 2]}"]
        out += _OPERATIONS[n]
    kind = shape(word)
    goal = "0" if to < OFTEN else "1" if to < 1e-5 * total else "2" if to < 1e-4 * total else "3"
    ratio = "a" if to < 2 * own else "b" if to < 15 * own else "c"
    known = "1" if own <= 2 else "2" if own < 1e-5 * total else "3" if own < 1e-4 * total else "4"
    out += [f"to {goal}", f"to {kind}{goal}", f"to {kind}{goal}{ratio}{known}", f"own {kind}{known}", f"ratio {ratio}", f"ratio {ratio}{known}", f"long {kind}{min(len(word), 7)}"]
    return out


def corrupt(word: str, rng: random.Random, signs: bool = False) -> tuple[str, tuple[tuple[int, int], ...]]:
    """The word with one or two confusions put in, and where (position in the result, confusion); ``signs``: only digits and marks."""
    spots = [(p, n) for n, (true, seen) in enumerate(CONFUSIONS) for p in range(len(word)) if word.startswith(true, p) and not (signs and seen.isalpha())]
    if not spots:
        return word, ()
    chosen = sorted(rng.sample(spots, min(len(spots), 1 + (rng.random() < 0.2))))
    out, gold, last, shift = [], [], 0, 0
    for p, n in chosen:
        if p < last:
            continue
        true, seen = CONFUSIONS[n]
        out.append(word[last:p] + seen)
        gold.append((p + shift, n))
        last = p + len(true)
        shift += len(seen) - len(true)
    return "".join(out) + word[last:], tuple(gold)


class Editor(Perceptron):
    """Predicts the edit of a word, or none."""

    def correction(self, word: str, own: int, to: dict[str, int], total: int, twice: bool = True) -> str | None:
        """What the word should be by the best edit of a score above 0, two at once only if one isn't enough; ``to``: counts of lower-cased words."""
        best, fix = 0.0, None
        for e in edits(word, twice):
            if len(e[0]) > 1 and fix is not None:
                break
            n = to.get(e[1].lower(), 0)
            if (n < OFTEN or n <= own) and (len(e[0]) > 1 or not _MIXED.search(word)):
                continue  # nothing speaks for it
            s = self.score(edit_features(word, e, own, n, total))
            if s > best:
                best, fix = s, e[1]
        return fix

    @classmethod
    def of_words(cls, words: list[str], names: list[str], count, total: int, seed: int = 3) -> Editor:
        """Fitted on words as they are, which no edit is right for, and with confusions put in; of names only confusions with digits and marks can be told.

        ``count`` gives the counts of a set of lower-cased words.
        """
        rng = random.Random(seed)
        shown = [(w, ()) for w in words + names]
        shown += [c for w in words for c in (corrupt(w, rng),) if c[1]] + [c for w in names for c in (corrupt(w, rng, True),) if c[1]]
        made = [(w, gold, edits(w, len(gold) > 1)) for w, gold in shown]
        counts = count({e[1].lower() for _, _, es in made for e in es} | {w.lower() for w, _, _ in made})
        # a word that may be a frequent misreading of a far more frequent one is no example of a right word
        doubt = {w for w in words if any(counts.get(e[1].lower(), 0) >= 15 * counts.get(w.lower(), 1) for e in single_edits(w))}
        examples = []
        for w, gold, es in made:
            if w in doubt:
                continue
            own = max(1, counts.get(w.lower(), 0))
            if gold:  # misreadings of frequent words are frequent too
                true = max((counts.get(e[1].lower(), 0) for e in es if e[0] == gold), default=1)
                own = max(own, true // rng.choice((20, 40, 10**9)))
            if not gold and es and own >= OFTEN:  # a right word isn't a rare misreading of it
                examples.append((edit_features(w, rng.choice(es), own, max(OFTEN, own // 50), total), -1))
            for e in es:
                n = counts.get(e[1].lower(), 0)
                if e[0] == gold or n >= OFTEN or (len(e[0]) == 1 and _MIXED.search(w)):
                    if e[0] == gold or e[1].lower() not in (x[1].lower() for x in es if x[0] == gold):
                        examples.append((edit_features(w, e, own, n, total), 1 if e[0] == gold else -1))
        return cls(Perceptron.fit(examples, seed=seed).w)


def clean(word: str) -> str:
    """The word without look-alikes, which problem 1 is about, and with one kind of s."""
    return transducer().apply(word).replace("ſ", "s")


# --- lines -----------------------------------------------------------------------------------


def is_transcript(text: Column) -> Column:
    """Several lines that are neither markup nor JSON. A bracket alone is no sign of these, as leaf numbers stand in brackets."""
    return text.contains("\n") & ~text.rlike(NO_TRANSCRIPT)


def is_number(text: Column) -> Column:
    """The shape of a page or leaf number."""
    return (F.length(text) <= 80) & (~text.contains(" ") | (F.length(text) <= 24)) & text.rlike(NUMBER)


def page_lines(equivs: DataFrame, regions: DataFrame) -> DataFrame:
    """The lines of both tables: field, row_key, volume, doc_id, region (from 0), line (from 0), at, main, top, second, edge, text. Null and blank texts are left out."""
    number = F.when(F.col("region_id").startswith("region_"), F.regexp_extract("region_id", r"(\d+)$", 1).try_cast("int")).otherwise(F.regexp_extract("region_id", r"(\d+)$", 1).try_cast("int") - 1)
    one = equivs.select(F.lit("TextEquiv.Unicode").alias("field"), F.col("equiv_id").cast("string").alias("row_key"), "volume", "doc_id", number.alias("region"), (F.regexp_extract("line_id", r"(\d+)$", 1).try_cast("int") - 1).alias("line"), F.col("equiv_id").alias("at"), (F.coalesce("equiv_index", F.lit(0)) == 0).alias("main"), F.col("unicode").alias("text"))
    flat = regions.select("volume", "doc_id", "region_id", "region_no", F.explode("lines").alias("l")).where(F.col("l").isNotNull())
    two = flat.select(F.lit("TextLineData.text").alias("field"), F.concat_ws("/", "doc_id", "region_id", F.col("l.idx").cast("string")).alias("row_key"), "volume", "doc_id", F.col("region_no").alias("region"), F.col("l.idx").alias("line"), (F.col("region_no").cast("long") * 100_000 + F.col("l.idx")).alias("at"), F.lit(True).alias("main"), F.col("l.text").alias("text"))
    out = one.unionByName(two).where(F.col("text").isNotNull() & (F.length(strip(F.col("text"))) > 0) & F.col("row_key").isNotNull())
    at = lambda k: F.coalesce((F.col("region") == 0) & (F.col("line") == k), F.lit(False))
    return out.withColumns({"top": at(0), "second": at(1), "edge": F.lit(False)})


def text_lines(records: DataFrame, key: str, text: str, field: str) -> DataFrame:
    """The lines of transcripts of several lines, as page_lines gives them: each text is a page. Null and single-line texts give nothing."""
    several = F.col(text).rlike(r"\S[^\n]*\n\s*\S")
    r = records.where(F.col(key).isNotNull() & F.col(text).isNotNull() & is_transcript(F.col(text)) & several).select(F.col(key).cast("string").alias("row_key"), F.split(F.col(text), "\n").alias("ls")).distinct()
    # each line with its neighbours, so that no line carries the whole text
    near = F.arrays_zip(F.col("ls").alias("text"), F.concat(F.array(F.lit("")), "ls").alias("before"), F.slice("ls", F.lit(2), F.size("ls")).alias("after"))
    r = r.select("row_key", F.posexplode(near).alias("i", "x")).select("row_key", "i", "x.text", strip(F.col("x.before")).alias("before"), strip(F.coalesce("x.after", F.lit(""))).alias("after"))
    edge = (F.col("before") == "") | is_number(F.col("before")) | is_number(F.col("after"))
    none = F.lit(None)
    out = r.where(F.col("text").isNotNull() & (F.length(strip(F.col("text"))) > 0)).select(F.lit(field).alias("field"), "row_key", none.cast("string").alias("volume"), F.col("row_key").alias("doc_id"), none.cast("int").alias("region"), F.col("i").alias("line"), F.col("i").cast("long").alias("at"), F.lit(True).alias("main"), "text", (F.col("i") == 0).alias("top"), F.lit(False).alias("second"), edge.alias("edge"))
    return out


def head_words(text: Column) -> Column:
    """The words of a line without numbers, each with signs that scanners take for one another as one sign."""
    t = F.lower(F.when(text.contains("  "), F.regexp_replace(text, EDGE, "")).otherwise(text))
    bare = F.regexp_replace(F.regexp_replace(t, r"(\p{L})\s?[\dlio]{3,4}(?!\p{L})", "$1 "), r"(?<![\p{L}\p{M}])[\dlio!]+(?![\p{L}\p{M}])", " ")
    t = F.when(t.rlike(r"\d"), F.translate(bare, "0159!+6", "oisgitb")).otherwise(t)
    for a, b in (("rn", "m"), ("cl", "d"), ("vv", "w"), ("in", "m"), ("ri", "n"), ("li", "h")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.regexp_extract_all(F.translate(t, "cefsrvkaonuhbil", "ccccvvvoonnbbii"), F.lit(r"([\p{L}\p{M}]+)"))


def words_of(text: str = "text") -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def prepared(lines: DataFrame) -> DataFrame:
    """All that is needed of the lines but counts: the text, how they end and begin, the shape for furniture, the keys of heads. Written once."""
    t = F.col("t")
    n = F.size("hw")
    ascii = F.length("text") == F.octet_length("text")
    d = lines.withColumn("t", strip(F.when(ascii, F.col("text")).otherwise(F.regexp_replace("text", UNDRAWN, ""))))
    d = d.withColumn("k", F.size(F.split("t", " +")))
    apart = F.col("edge") | t.contains("  ") | t.rlike(r"\d") | (t == F.upper(t))
    asked = (F.col("k") <= HEAD_WORDS + 3) & (F.col("top") | (F.col("volume").isNull() & apart))  # only these are compared with heads
    d = d.select("*", F.explode(F.array(F.struct(F.when(asked, head_words(t)).alias("hw"), F.right(t, F.lit(1)).alias("last"), is_number(t).alias("n")))).alias("x")).select("*", "x.hw", F.col("x.last").alias("last"), F.col("x.n").alias("numbered")).drop("x")
    last = F.col("last")
    double = t.contains("  ")
    ends = last.isin(*HYPHENS) & F.regexp_like(F.substring(t, -2, 1), F.lit(r"\p{L}"))
    shapes = {
        "number": F.col("numbered"),
        "year_line": (F.length(t) <= 5) & t.rlike(r"^\d{1,4}\.$"),
        "roman": (F.col("k") == 1) & t.rlike(r"^[ivxlcdmIVXLCDM1!]+$"),
        "marked": t.rlike(r"^(?:[\[(—–·-]|(?i:fol|pag|bl)\b)"),
        "year": F.right(t, F.lit(9)).rlike(r"[\dlIOo]{3,4}[\s·.—–-]*$") & ~F.col("numbered"),
        "edge_number": double & t.rlike(EDGE),
        "caps": (t == F.upper(t)) & (F.lower(t) != F.upper(t)) & (F.length(t) >= 4),
        "low": t.rlike(r"^\p{Ll}"),
        "stop": last.isin(".", ";", ",", ":"),
        "comma": t.contains(", ") | t.contains("; "),
        "few": F.col("k") <= 3,
        "middle": F.col("k").between(4, 9),
    }
    # of a wording its first half, its second half without the last word, and the last word, which names the place; so noise in one leaves the others
    half = F.ceil(n / 2).cast("int")
    part = lambda kind, a, size: F.struct(F.lit(kind).alias("kind"), F.array_join(F.slice("hw", a, size), " ").alias("key"))
    place = F.try_element_at("hw", F.lit(-1))
    keys = F.when(n <= HEAD_WORDS, F.array_compact(F.array(F.when(n >= 3, part("title", F.lit(1), half)), F.when(n >= 4, part("rest", half + 1, n - half - 1)), F.when(F.length(place) >= 4, F.struct(F.lit("place").alias("kind"), place.alias("key"))))))
    keep = ["field", "row_key", "volume", "doc_id", "region", "line", "at", "main", "top", "second", "edge"]
    return written(
        d.select(
            *keep, F.col("t").alias("text"), *[F.coalesce(c, F.lit(False)).alias(k) for k, c in shapes.items()], keys.alias("keys"),
            F.when(ends, last).alias("sign"), F.when(ends, F.lower(F.regexp_extract("t", r"([\p{L}\p{M}]+).$", 1))).alias("left"), F.regexp_extract("t", r"^([\p{L}\p{M}]*)", 1).alias("right"),
        ),
        "lines",
    )


# --- words of the corpus ---------------------------------------------------------------------


class Words:
    """The counts of all words, the editor fitted on some of them, and what it calls misread."""

    def __init__(self, lines: DataFrame) -> None:
        spark = lines.sparkSession
        w = lines.where("main AND field <> 'TextLineData.text'").select(F.explode(words_of()).alias("word")).groupBy("word").agg(F.count("*").alias("n"))  # the lines of regions are those of the pages
        self.words = written(w.withColumn("low", F.lower("word")), "words")
        self.counts = self.words.groupBy("low").agg(F.sum("n").alias("n"))
        row = self.counts.agg(F.sum("n").alias("total"), F.count("*").alias("rows")).first()
        self.total, self.rows = int(row["total"] or 0), row["rows"]
        plain = self.words.where(F.regexp_like("word", F.lit(r"^[\p{L}\p{M}'’-]{3,}$")))
        draw = lambda d, n: [r["word"] for r in d.orderBy(F.xxhash64("word"), "word").limit(n).select("word").collect()]
        words = draw(plain.where(F.col("n") >= OFTEN), SAMPLE_WORDS)
        names = draw(plain.where((F.col("n") < OFTEN) & F.regexp_like("word", F.lit(r"^\p{Lu}\p{Ll}{3,}"))), SAMPLE_NAMES)

        def count(wanted: set[str]) -> dict[str, int]:  # of the edits of the sample
            asked = spark.createDataFrame(pa.table({"low": pa.array(sorted(wanted), pa.string())}))
            got = self.counts.join(asked, "low").toArrow()
            return dict(zip(got["low"].to_pylist(), got["n"].to_pylist()))

        self.editor = Editor.of_words(words, names, count, self.total)
        self.sample = words

    def misread(self, editor: Editor | None = None) -> DataFrame:
        """(word, fix, inside) of all distinct words the editor edits; ``inside``: a digit or mark stands between letters."""
        total = self.total
        shared = self.words.sparkSession.sparkContext.broadcast((editor or self.editor).w)  # features of the fitting sample

        def forms(word: str, n: int) -> tuple[str, bool]:
            w = clean(word)
            return w, n < OFTEN or n < RARE * total if w.islower() or _MIXED.search(w) else False

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows: list[tuple[str, int, str]] = []
                for word, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    if len(word) < 3 or word.isdigit() or _ORDINAL.match(word):
                        continue
                    w, twice = forms(word, n)
                    es = edits(w, twice)
                    if es:
                        rows.append((word, n, w.lower()))
                        rows += [(word, n, low) for low in {e[1].lower() for e in es}]
                    if len(rows) > 50_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.string()))], ["word", "here", "low"])
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.string()))], ["word", "here", "low"])

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            e = Editor(shared.value)
            for b in batches:
                out: list[tuple[str, str]] = []
                for word, n, met in zip(*(b.column(k).to_pylist() for k in range(3))):
                    w, twice = forms(word, n)
                    to = dict(zip((m["low"] for m in met), (m["n"] for m in met)))
                    own = max(1, to.get(w.lower(), 0))
                    if w != word and (own >= OFTEN or not w.isascii()):
                        continue  # spelt with look-alikes, not misread
                    fix = e.correction(w, own, to, total, twice)
                    if fix is not None:
                        out.append((word, fix))
                yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.string()) for k in range(2)], ["word", "fix"])

        asked = self.words.select("word", "n").mapInArrow(spread, "word string, here long, low string")
        met = asked.join(small_side(self.counts, self.rows, MAX_BROADCAST_WORDS), "low").groupBy("word", "here").agg(F.collect_list(F.struct("low", "n")).alias("met"))
        found = met.mapInArrow(judge, "word string, fix string")
        return checkpointed(found.withColumn("inside", F.regexp_like("word", F.lit(INSIDE))))


def misread_places(lines: DataFrame, misread: DataFrame) -> DataFrame:
    """(KEY, first, other, fixes): lines with a misread first word, one elsewhere, and (word, fix) of all.

    A word at the end of a line that ends in a hyphen counts only if signs stand inside it.
    """
    small = small_side(misread, misread.count(), MAX_BROADCAST_WORDS)
    w = lines.select(*KEY, F.col("sign").isNotNull().alias("cut"), F.explode(F.array(words_of())).alias("words")).select("*", F.size("words").alias("k"), F.posexplode("words").alias("p", "word")).drop("words").join(small, "word")
    counts = F.col("inside") | ~(F.col("cut") & (F.col("p") == F.col("k") - 1))
    return w.groupBy(*KEY).agg(F.bool_or(counts & ~F.col("inside") & (F.col("p") == 0)).alias("first"), F.bool_or(counts & (F.col("inside") | (F.col("p") > 0))).alias("other"), F.collect_set(F.when(counts, F.struct("word", "fix"))).alias("fixes"))


# --- line joins ------------------------------------------------------------------------------


def own_hyphens(lines: DataFrame) -> DataFrame:
    """(left, right, n): words with a hyphen between them inside lines, which the text has of its own."""
    hyphen = r"([\p{L}\p{M}]+)-\s?([\p{L}\p{M}]+)"
    both = F.arrays_zip(*[F.regexp_extract_all(F.lower("text"), F.lit(hyphen), F.lit(k)).alias(side) for k, side in ((1, "left"), (2, "right"))])
    w = lines.where("main AND field <> 'TextLineData.text' AND contains(text, '-')").select(F.explode(both).alias("h"))
    return checkpointed(w.groupBy("h.left", "h.right").agg(F.count("*").alias("n")))


def join_features(sign: str, own: int, joined: int) -> list[str]:
    return [f"sign {sign}", f"own {'0' if not own else 'a' if own < joined else 'b'}", f"joined {'1' if joined else '0'}", f"{sign}{'0' if not own else 'a' if own < joined else 'b'}"]


def join_column(model: Perceptron, sign: Column, own: Column, joined: Column) -> Column:
    """The score of a line join as a column."""
    kind = F.when(own == 0, "0").when(own < joined, "a").otherwise("b")
    score = sum((F.when(sign == h, F.lit(model.w.get(f"sign {h}", 0.0))).otherwise(0.0) for h in HYPHENS), F.lit(0.0))
    for k in "0ab":
        score = score + F.when(kind == k, F.lit(model.w.get(f"own {k}", 0.0))).otherwise(0.0)
        for h in HYPHENS:
            if w := model.w.get(f"{h}{k}", 0.0):
                score = score + F.when((kind == k) & (sign == h), F.lit(w)).otherwise(0.0)
    return score + F.when(joined > 0, F.lit(model.w.get("joined 1", 0.0))).otherwise(F.lit(model.w.get("joined 0", 0.0)))


def fit_joins(words: list[str], compounds: list[tuple[str, str, int]], seed: int = 4) -> Perceptron:
    """From words cut at any place, half of them as if they stood nowhere else, and from compounds cut at their hyphen."""
    rng = random.Random(seed)
    cut = [(join_features(rng.choice(HYPHENS), 0, n), 1) for _ in words for n in (0, 5)]
    cut += [(join_features(rng.choice(HYPHENS), 1, 50), 1) for _ in words[: len(words) // 20]]  # a noisy compound of a word that stands often
    own = [(join_features(rng.choice("-‐‑"), n, 0), -1) for _, _, n in compounds] * max(1, len(cut) // (4 * max(1, len(compounds))))
    return Perceptron.fit(cut + own, seed=seed)


# --- furniture -------------------------------------------------------------------------------

SHAPES = ("number", "year_line", "roman", "marked", "year", "edge_number", "caps", "low", "stop", "comma", "few", "middle")
PLACES = ("top", "second", "alone", "pair", "title_again", "place_again")
TOGETHER = (("top", "few", "year"), ("top", "alone", "caps"), ("top", "title_again", "place_again"), ("top", "middle", "title_again"), ("top", "middle", "place_again"), ("second", "title_again"), ("top", "alone"), ("top", "pair"), ("top", "title_again"), ("top", "place_again"), ("title_again", "place_again"), ("top", "year"), ("few", "year"), ("top", "caps"), ("caps", "alone"), ("number", "alone"), ("number", "top"), ("number", "pair"), ("number", "roman"), ("number", "marked"), ("number", "year_line"), ("top", "low"), ("top", "few"), ("few", "place_again"), ("alone", "low"), ("top", "comma"), ("top", "stop"))


def furniture_features(flags: dict[str, bool]) -> list[str]:
    """The flags that hold and the groups of them that hold together."""
    return ["any", *(k for k in SHAPES + PLACES if flags[k]), *("&".join(g) for g in TOGETHER if all(flags[k] for k in g))]


def furniture_column(model: Perceptron) -> Column:
    """The score of a line as a column over its flags."""
    out = F.lit(model.w.get("any", 0.0))
    for group in [*((k,) for k in SHAPES + PLACES), *TOGETHER]:
        if w := model.w.get("&".join(group)):
            out = out + F.when(reduce(Column.__and__, map(F.col, group)), F.lit(w)).otherwise(0.0)
    return out


def titles(lines: DataFrame) -> DataFrame:
    """(volume, kind, key): wordings and place names at the head of several pages of a volume."""
    heads = lines.where("top AND main AND field = 'TextEquiv.Unicode' AND NOT number AND volume IS NOT NULL")
    of = heads.groupBy("volume").agg(F.count_distinct("doc_id").alias("of"))
    again = heads.select("volume", "doc_id", F.explode("keys").alias("k")).groupBy("volume", "k.kind", "k.key").agg(F.count_distinct("doc_id").alias("pages")).where("pages >= 2")
    return written(again.join(of, "volume").where(F.col("pages") >= HEAD_SHARE * F.col("of")).select("volume", "kind", "key"), "titles")


def placed(lines: DataFrame, again: DataFrame) -> DataFrame:
    """Lines with the flags of their place: top, alone in its region (or one of a pair), wording and place name that stand at the head of other pages too.

    On pages both are sought in the line's own volume; texts have none, so there the heads of
    all volumes count, and a line that has both or stands between pages counts as a top one.
    """
    flags = [F.bool_or(F.col("kind") != "place").alias("title_again"), F.bool_or(F.col("kind") == "place").alias("place_again")]
    asked = lines.where("keys IS NOT NULL AND volume IS NOT NULL AND top").select(*KEY, "volume", F.explode("keys").alias("k")).select(*KEY, "volume", "k.*")
    known = asked.join(again, ["volume", "kind", "key"]).groupBy(*KEY).agg(*flags)
    asked = lines.where("keys IS NOT NULL AND volume IS NULL").select(*KEY, F.explode("keys").alias("k")).select(*KEY, "k.*")
    known = known.unionByName(asked.join(again.select("kind", "key").distinct(), ["kind", "key"]).groupBy(*KEY).agg(*flags))
    flat = lines.drop("text")
    other = flat.where("keys IS NULL").drop("keys").withColumns({"title_again": F.lit(False), "place_again": F.lit(False)})  # most lines, which no join moves
    some = flat.where("keys IS NOT NULL").drop("keys").join(known, KEY, "left").withColumns({"title_again": F.coalesce("title_again", F.lit(False)), "place_again": F.coalesce("place_again", F.lit(False))})
    out = other.unionByName(some).repartition("doc_id")
    texts = F.col("field") == "SFT.completion"
    between = texts & ((F.col("title_again") & F.col("place_again")) | (F.col("place_again") & (F.col("edge_number") | (F.col("few") & F.col("year")))))
    edge = F.col("edge") | between
    around = Window.partitionBy("field", "doc_id", "region")  # several deliveries of a line have one place
    extent = lambda c: F.max(c).over(around) - F.min(c).over(around)
    out = out.withColumns({"_at": extent("at"), "_line": extent("line")})
    pair = ~texts & (F.coalesce("region", F.lit(-1)) == 0) & (F.coalesce("_line", F.lit(0)) == 1)
    return out.withColumns({"alone": F.when(texts, edge | F.col("number")).otherwise(F.col("_at") == 0), "pair": pair, "top": F.when(texts, edge).otherwise(F.col("top"))}).drop("_at", "_line", "line", "edge")


def fit_furniture(rows: list[dict[str, bool]], seed: int = 6) -> tuple[Perceptron, Perceptron]:
    """(running heads, page numbers) from a sample of lines of pages.

    What is surely a head (a wording at the head of several pages of its volume) is shown also
    as if it stood nowhere else, and what is surely body text also as if it stood at the head.
    """
    heads: list[tuple[list[str], int]] = []
    numbers: list[tuple[list[str], int]] = []
    for r in rows:
        again, f = r["title_again"] or r["place_again"], furniture_features
        if r["number"]:
            numbers.append((f(r), 1 if r["alone"] or r["pair"] else -1))
            heads.append((f(r), -1))
        elif r["top"] and again and (r["alone"] or r["pair"]):
            heads += [(f(r | x), 1) for x in ({}, {"title_again": False}, {"place_again": False}, {"pair": True, "alone": False}, {"alone": True, "pair": False})]
            if r["few"] and r["year"]:  # a short title
                heads.append((f(r | {"title_again": False, "place_again": False}), 1))
            numbers.append((f(r), -1))
        elif not r["top"]:
            heads += [(f(r | x), -1) for x in ({}, {"title_again": True}, {"place_again": True}, {"top": True, "alone": True}, {"top": True, "pair": True, "alone": False})]
            if len(heads) % 4 == 0:
                heads.append((f(r | {"top": True, "alone": True, "place_again": True}), -1))
            numbers.append((f(r), -1))
        elif not again:
            heads.append((f(r), -1))
            numbers.append((f(r), -1))
    return Perceptron.fit(heads, 6, seed, 1.0), Perceptron.fit(numbers, 6, seed, 1.0)


# --- judging ---------------------------------------------------------------------------------


class Scan:
    """The lines of pages and texts, prepared, with everything learned from them."""

    def __init__(self, lines: DataFrame) -> None:
        self.lines = prepared(lines)
        self.words = Words(self.lines)
        self.own = own_hyphens(self.lines)
        compounds = self.own.where("n >= 2").orderBy(F.xxhash64("left", "right"), "left", "right").limit(SAMPLE_COMPOUNDS).collect()
        self.joins = fit_joins(self.words.sample, [tuple(r) for r in compounds])
        self.again = titles(self.lines)
        pages = [r["doc_id"] for r in self.lines.where("main AND field = 'TextEquiv.Unicode'").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_PAGES).collect()]
        drawn = placed(self.lines.where(F.col("doc_id").isin(pages) & (F.col("field") == "TextEquiv.Unicode") & F.col("main")), self.again)
        rows = drawn.orderBy(F.xxhash64("row_key"), "row_key").limit(SAMPLE_LINES).select(*SHAPES, *PLACES).collect()
        self.heads, self.numbers = fit_furniture([r.asDict() for r in rows])

    def placed(self) -> DataFrame:
        return placed(self.lines, self.again)

    def judged(self) -> tuple[DataFrame, DataFrame]:
        """(lines, pages): the lines, deliveries of one alike, with is_head, is_number, body, the first word of the next body line of its page and whether the one before ends in a hyphen; and of each page the same about the pages around it. Written once.

        Pages are brought in order inside blocks of BLOCK_PAGES page numbers, so no task holds a whole volume.
        """
        j = self.placed().withColumns({"is_number": furniture_column(self.numbers) > 0, "is_head": furniture_column(self.heads) > 0})
        j = j.select(*KEY, "volume", "sign", "left", "right", "is_number", (F.col("is_head") & ~F.col("is_number")).alias("is_head"), (F.col("main") & ~F.col("is_head") & ~F.col("is_number")).alias("body"))
        w = Window.partitionBy("field", "doc_id").orderBy("at")
        back = Window.partitionBy("field", "doc_id").orderBy(F.desc("at"))
        before = (Window.unboundedPreceding, -1)  # in both orders, so that the frames only grow; by place, so that copies of a line don't count
        cut = F.col("sign").isNotNull()
        j = j.withColumn("next", F.last(F.when(F.col("body"), F.col("right")), True).over(back.rangeBetween(*before))).withColumn("prev", F.last(F.when(F.col("body"), cut), True).over(w.rangeBetween(*before)))
        j = written(j, "judged")
        no = F.coalesce(F.regexp_extract("doc_id", r"(\d+)$", 1).try_cast("long"), F.lit(0).cast("long"))
        edges = j.where(F.col("body") & F.col("volume").isNotNull() & (F.col("next").isNull() | F.col("prev").isNull()))  # the first and last body lines of pages
        pages = edges.groupBy("field", "volume", "doc_id").agg(F.min_by("right", "at").alias("opens"), F.max_by(cut, "at").alias("closes")).withColumn("no", no)
        pages = pages.withColumn("block", F.floor(F.col("no") / BLOCK_PAGES))
        in_block = F.col("no") % BLOCK_PAGES
        blocks = F.array_compact(F.array(F.struct(F.col("block").alias("block"), F.lit(True).alias("own")), F.when(in_block < NEAR_PAGES, F.struct((F.col("block") - 1).alias("block"), F.lit(False).alias("own"))), F.when(in_block >= BLOCK_PAGES - NEAR_PAGES, F.struct((F.col("block") + 1).alias("block"), F.lit(False).alias("own")))))
        p = pages.select("*", F.explode(blocks).alias("e")).drop("block")
        wp = Window.partitionBy("field", "volume", "e.block").orderBy("no", "doc_id")
        p = p.withColumn("page_next", F.lead("opens").over(wp)).withColumn("page_prev", F.lag("closes").over(wp)).where("e.own").select("field", "doc_id", "page_next", "page_prev")
        return j, written(p, "pages")

    def hyphen_breaks(self, j: DataFrame, pages: DataFrame) -> DataFrame:
        """KEY of the lines that end inside a word: only those that end in a hyphen are joined with anything."""
        c = j.where("body AND sign IS NOT NULL").join(pages, ["field", "doc_id"], "left").withColumn("right", F.lower(F.coalesce("next", "page_next"))).where("right IS NOT NULL").select(*KEY, "sign", "left", "right")
        c = c.join(self.own, ["left", "right"], "left").withColumnRenamed("n", "own")
        c = c.join(self.words.counts.select(F.col("low").alias("_j"), F.col("n").alias("joined")), F.concat("left", "right") == F.col("_j"), "left")
        score = join_column(self.joins, F.col("sign"), F.coalesce("own", F.lit(0)), F.coalesce("joined", F.lit(0)))
        return c.where(score > 0).select(*KEY)

    def kinds(self) -> DataFrame:
        """(field, row_key, kind)."""
        j, pages = self.judged()
        kind = lambda df, k: df.select("field", "row_key", F.lit(k).alias("kind"))
        m = misread_places(self.lines, self.words.misread()).where("first OR other").select(*KEY, "first", "other")
        m = checkpointed(m)
        m = small_side(m, m.count(), MAX_BROADCAST_WORDS).join(j.where("NOT is_head AND NOT is_number").select(*KEY, "prev"), KEY).join(pages.drop("page_next"), ["field", "doc_id"], "left")
        m = m.where("other OR NOT coalesce(prev, page_prev, false)")
        parts = (kind(j.where("is_head"), "running_head"), kind(j.where("is_number"), "page_number"), kind(self.hyphen_breaks(j, pages), "hyphen_break"), kind(m, "misread"))
        return reduce(DataFrame.unionByName, parts).distinct()

    def repaired(self) -> DataFrame:
        """(field, doc_id, repaired): furniture removed, words joined over lines, misread words corrected; blank lines part paragraphs."""
        j, pages = self.judged()
        j = j.distinct()
        broken = self.hyphen_breaks(j, pages).distinct().withColumn("hyphen_break", F.lit(True))
        part = F.when(F.col("volume").isNull(), F.col("at") - F.row_number().over(Window.partitionBy("field", "doc_id").orderBy("at", "row_key"))).otherwise(0)  # grows at blank lines
        j = j.withColumn("paragraph", part).where("body").join(self.lines.select(*KEY, "text").distinct(), KEY).join(broken, KEY, "left").join(misread_places(self.lines, self.words.misread()).select(*KEY, "fixes"), KEY, "left")
        edge = r"(?<![\p{L}\p{M}\p{N}+!])\Q"
        fixed = F.aggregate(F.coalesce("fixes", F.array().cast("array<struct<word:string,fix:string>>")), F.col("text"), lambda t, x: F.regexp_replace(t, F.concat(F.lit(edge), x["word"], F.lit(r"\E(?![\p{L}\p{M}\p{N}])")), F.regexp_replace(x["fix"], r"([\\$])", r"\\$1")))
        line = F.when(F.coalesce("hyphen_break", F.lit(False)), F.expr("substring(fixed, 1, length(fixed) - 1)")).otherwise(F.concat("fixed", F.lit(" ")))
        p = j.withColumn("fixed", fixed).groupBy("field", "doc_id", "paragraph").agg(F.array_sort(F.collect_list(F.struct("at", "row_key", line.alias("t")))).alias("ls"))
        p = p.select("field", "doc_id", "paragraph", F.trim(F.array_join(F.transform("ls", lambda x: x["t"]), "")).alias("t"))
        return p.groupBy("field", "doc_id").agg(F.array_sort(F.collect_list(F.struct("paragraph", "t"))).alias("ps")).select("field", "doc_id", F.array_join(F.transform("ps", lambda x: x["t"]), "\n\n").alias("repaired"))


def all_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    equivs = table(spark, sf_dir, "text_equivs").select("equiv_id", "volume", "doc_id", "region_id", "line_id", "equiv_index", "unicode")
    pages = page_lines(equivs, table(spark, sf_dir, "regions").select("volume", "doc_id", "region_id", "region_no", "lines"))
    return pages.unionByName(text_lines(table(spark, sf_dir, "sft_records"), "record_id", "completion", "SFT.completion"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Scan(all_lines(spark, sf_dir)).kinds()


def p4_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transcripts of sft_records as continuous paragraphs."""
    return Scan(all_lines(spark, sf_dir)).repaired().where("field = 'SFT.completion'").select(F.col("doc_id").cast("long").alias("record_id"), "repaired")


def p4_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of regions as continuous paragraphs; a page is one row."""
    return Scan(all_lines(spark, sf_dir)).repaired().where("field = 'TextLineData.text'").select("doc_id", "repaired")


QUERIES = {"p4_found": p4_found, "p4_transcripts": p4_transcripts, "p4_pages": p4_pages}
