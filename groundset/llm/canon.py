"""Problem 1: one form for texts that look the same.

A transducer is compiled once from rules: every source cluster (one sign, or a base with
its combining marks) has one target. It then walks a text once, takes the longest match at
each place and copies everything else. Compilation checks that no source has two targets,
that targets are fixed points and that signs a reader tells apart keep different targets.
"""

from __future__ import annotations

import re
import unicodedata as U
from collections.abc import Iterator
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundset.functions.text import strip
from groundset.session import table, written

HOT_ROWS = 5_000  # of one form, above which it is spread over several tasks

#: Letters of other scripts that have the shape of a Latin letter.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j",
    "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ѵ": "v",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T",
    "У": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "Ԛ": "Q", "Ԝ": "W", "Ӏ": "I", "Ѵ": "V", "Ү": "Y",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "ϲ": "c", "ϳ": "j", "Ϲ": "C", "Ϳ": "J",
    "ɡ": "g", "ɑ": "a", "ո": "n", "ս": "u", "օ": "o", "ց": "g", "հ": "h", "Օ": "O", "Տ": "S", "Լ": "L",
    "K": "K", "ı̇": "i",
    "‐": "-", "‑": "-", ";": ";", "·": "·",
}
#: Signs of which a reader tells every two apart; their targets must differ.
DISTINCT = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789¹²³ſßæÆøØ.,:;!?'\"-–—‘’“”()[]{}/·"
MARK = "̀-ͯ᪰-᫿᷀-᷿⃐-⃰︠-︯"
#: Signs that draw nothing and aren't in the category of format signs.
UNDRAWN = "͏ᅟᅠ឴឵ㅤﾠ" + "".join(map(chr, [*range(0x180B, 0x180F), *range(0xFE00, 0xFE10)]))


def _compat(ch: str) -> str | None:
    """The target of a sign that differs from another one in width only or joins letters."""
    tag, _, rest = U.decomposition(ch).partition("> ")
    if tag in ("<wide", "<narrow") or (tag == "<compat" and (0xFB00 <= ord(ch) <= 0xFB06 or ch in "ĲĳǇǈǉǊǋǌ")):
        # the long s inside a joined letter stays a long s
        return "".join(chr(int(x, 16)) for x in rest.split())
    return None


class Transducer:
    """clusters: source -> target; ``apply`` rewrites a text in one pass, longest match first."""

    def __init__(self, rules: list[tuple[str, str]]) -> None:
        clusters: dict[str, str] = {}
        for source, target in rules:
            if clusters.setdefault(source, target) != target:
                raise ValueError(f"two targets for {source!r}: {clusters[source]!r} and {target!r}")
        self.clusters = clusters
        self.longest = max(map(len, clusters), default=0)
        starts = "".join(re.escape(c) for c in sorted({s[0] for s in clusters}))
        # a trigger: a sign that starts a source, or any sign with combining marks after it
        self.trigger = re.compile(f"(?:[{starts}]|[^{MARK}](?=[{MARK}]))[{MARK}]*|[{MARK}]+") if starts else None
        self.cluster = lru_cache(maxsize=1 << 16)(self._cluster)
        for source, target in clusters.items():
            if self.apply(target) != target:
                raise ValueError(f"the target of {source!r} isn't a fixed point: {target!r}")
        seen: dict[str, str] = {}
        for ch in DISTINCT:
            if seen.setdefault(self.apply(ch), ch) != ch:
                raise ValueError(f"{ch!r} and {seen[self.apply(ch)]!r} would become equal")

    def _cluster(self, text: str) -> str:
        """The target of a base with its marks: longest known source first, then its parts, composed."""
        for n in range(min(self.longest, len(text)), 0, -1):
            if (to := self.clusters.get(text[:n])) is not None:
                return U.normalize("NFC", to + "".join(self.clusters.get(c, c) for c in text[n:]))
        base = U.normalize("NFD", text)
        return U.normalize("NFC", "".join(self.clusters.get(c, c) for c in base))

    def apply(self, text: str) -> str:
        if text.isascii() and text.isprintable():  # none of the control signs that stand for blanks
            return text
        out = self.trigger.sub(lambda m: self.cluster(m[0]), text)
        if out.isascii():
            return out
        return U.normalize("NFC", out)  # a mark that followed a sign which draws nothing


@lru_cache(maxsize=1)
def transducer() -> Transducer:
    """Compiled from the rules for widths, joined letters, blanks, signs that draw nothing and look-alikes."""
    rules: list[tuple[str, str]] = []
    for n in range(0x80, 0x20000):
        ch = chr(n)
        kind = U.category(ch)
        if ch in LOOK_ALIKES:
            continue
        if kind == "Cf" or ch in UNDRAWN:
            rules.append((ch, ""))
        elif kind in ("Zs", "Zl", "Zp"):
            rules.append((ch, " "))
        elif (to := _compat(ch)) is not None:
            rules.append((ch, " " if to == " " else LOOK_ALIKES.get(to, to)))
        elif kind[0] == "L" and (d := U.normalize("NFD", ch)) != ch and d[0] in LOOK_ALIKES:
            rules.append((ch, U.normalize("NFC", LOOK_ALIKES[d[0]] + d[1:])))  # a look-alike with its accent
        elif U.normalize("NFC", ch) != ch:
            to = U.normalize("NFC", ch)
            rules.append((ch, LOOK_ALIKES.get(to, to)))
    rules += [("\t", " "), ("\n", " "), ("\r", " "), ("\x0b", " "), ("\x0c", " "), ("\x85", " ")]
    rules += list(LOOK_ALIKES.items())
    return Transducer(rules)


def canonical(text: str | None) -> str | None:
    """The one form of a text, without outer white space; None if nothing is left."""
    return None if text is None else transducer().apply(text).strip() or None


def canonical_form(df: DataFrame, text: str, to: str = "canonical") -> DataFrame:
    """Add the column ``to`` with the one form of ``text``.

    Null, empty and blank texts and those of signs that draw nothing get null. All other
    columns stay as they are, except that an older column ``to`` is replaced.
    """
    keep = [c for c in df.columns if c != to]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(to, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer()
        for b in batches:
            out = [None if s is None else t.apply(s).strip() or None for s in b.column(text).to_pylist()]
            cols = [b.column(c) for c in keep] + [pa.array(out, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, [*keep, to])

    return df.mapInArrow(run, schema)


def spellings(df: DataFrame, key: str, text: str) -> DataFrame:
    """(id, h1, h2, s1, s2): the hash of each text's one form and of its spelling, 96 bits each, so no text is shuffled; written once.

    Null and blank texts and null keys are left out.
    """
    rows = canonical_form(df.select(F.col(key).alias("id"), F.col(text).alias("raw")).where(F.col("raw").isNotNull() & F.col("id").isNotNull()), "raw", "form")
    raw = strip(F.col("raw"))
    return written(rows.where(F.col("form").isNotNull()).select("id", F.xxhash64("form").alias("h1"), F.hash(F.reverse("form")).alias("h2"), F.xxhash64(raw).alias("s1"), F.hash(F.reverse(raw)).alias("s2")), "spellings")


def mixed_forms(rows: DataFrame) -> DataFrame:
    """(h1, h2, n): forms with at least two spellings, and how many rows have them."""
    g = rows.groupBy("h1", "h2").agg(F.min("s1").alias("a1"), F.max("s1").alias("z1"), F.min("s2").alias("a2"), F.max("s2").alias("z2"), F.count("*").alias("n"))
    return g.where("a1 <> z1 OR a2 <> z2").select("h1", "h2", "n")


def look_alike_pairs(df: DataFrame, key: str, text: str, hot: int = HOT_ROWS) -> DataFrame:
    """id_a < id_b: rows whose texts look the same but differ in code points.

    Null and blank texts pair with nothing; repeated deliveries of a key count once; a key
    with two texts that look alike isn't paired with itself. Exact copies aren't compared
    with each other: the texts are joined spelling by spelling, so the output is the pairs
    between spellings only. A form of more than ``hot`` rows is spread over as many parts as
    that number goes into its rows; other forms aren't copied.
    """
    rows = spellings(df, key, text)
    met = rows.join(mixed_forms(rows), ["h1", "h2"]).distinct().withColumn("parts", F.ceil(F.col("n") / hot).cast("int")).drop("n")
    a = met.withColumn("salt", F.pmod(F.hash("id"), F.col("parts"))).alias("a")
    b = met.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).alias("b")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in ("h1", "h2", "salt")]
    differ = (F.col("a.s1") != F.col("b.s1")) | (F.col("a.s2") != F.col("b.s2"))
    return a.join(b, reduce(Column.__and__, same) & differ & (F.col("a.id") < F.col("b.id"))).select(F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b")).distinct()


def look_alike_classes(df: DataFrame, key: str, text: str) -> DataFrame:
    """(id, class_id, links): every row that looks like one of another spelling, the least id of its class, and with how many rows of the class its spelling isn't shared.

    Counts of classes and spellings are aggregates, so the size of a class doesn't matter.
    """
    rows = spellings(df, key, text)
    met = rows.join(mixed_forms(rows).drop("n"), ["h1", "h2"]).distinct()
    whole = met.groupBy("h1", "h2").agg(F.min("id").alias("class_id"), F.count_distinct("id").alias("n"))
    own = met.groupBy("h1", "h2", "s1", "s2").agg(F.count("*").alias("m"))
    out = met.join(own, ["h1", "h2", "s1", "s2"]).join(whole, ["h1", "h2"])
    return out.groupBy("id", "class_id").agg(F.max(F.col("n") - F.col("m")).alias("links"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = look_alike_pairs(table(spark, sf_dir, "text_equivs"), "equiv_id", "unicode").select(F.lit("TextEquiv.Unicode").alias("field"), "id_a", "id_b")
    two = look_alike_pairs(table(spark, sf_dir, "text_chunks"), "chunk_id", "text").select(F.lit("TextChunk.text").alias("field"), "id_a", "id_b")
    return one.unionByName(two)


def p1_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each row that looks like one of another spelling, with its class and number of links."""
    one = look_alike_classes(table(spark, sf_dir, "text_equivs"), "equiv_id", "unicode").withColumn("field", F.lit("TextEquiv.Unicode"))
    two = look_alike_classes(table(spark, sf_dir, "text_chunks"), "chunk_id", "text").withColumn("field", F.lit("TextChunk.text"))
    return one.unionByName(two)


def p1_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of both tables in its one form, deliveries of a key counted once."""
    one = canonical_form(table(spark, sf_dir, "text_equivs").select(F.lit("TextEquiv.Unicode").alias("field"), F.col("equiv_id").alias("id"), F.col("unicode").alias("text")), "text")
    two = canonical_form(table(spark, sf_dir, "text_chunks").select(F.lit("TextChunk.text").alias("field"), F.col("chunk_id").alias("id"), F.col("text")), "text")
    return one.unionByName(two).select("field", "id", "canonical").distinct()


def _sql() -> str:
    """The same mapping as SQL: sign by sign, then composed."""
    q = lambda s: s.replace("'", "''")
    one = [(a, b) for a, b in transducer().clusters.items() if len(a) == 1 and len(b) == 1]
    gone = "".join(a for a, b in transducer().clusters.items() if len(a) == 1 and not b)
    more = [(a, b) for a, b in transducer().clusters.items() if len(a) == 1 and len(b) > 1]
    form = f"translate(t, '{q(''.join(a for a, _ in one))}{gone}', '{q(''.join(b for _, b in one))}')"
    for a, b in more:
        form = f"replace({form}, '{q(a)}', '{q(b)}')"
    strip = lambda x: f"regexp_replace({x}, '^[\\s\\x{{0b}}\\x{{1c}}-\\x{{1f}}\\x{{85}}\\pZ]+|[\\s\\x{{0b}}\\x{{1c}}-\\x{{1f}}\\x{{85}}\\pZ]+$', '', 'g')"
    return f"""WITH t AS (SELECT DISTINCT 'TextEquiv.Unicode' AS field, equiv_id AS id, unicode AS t FROM text_equivs UNION SELECT DISTINCT 'TextChunk.text', chunk_id, text FROM text_chunks),
c AS (SELECT field, id, {strip("t")} AS raw, nullif({strip(f"nfc_normalize({form})")}, '') AS canonical FROM t)
"""


QUERIES = {"p1_found": p1_found, "p1_classes": p1_classes, "p1_canonical": p1_canonical}
ORACLE = {
    "p1_found": _sql() + "SELECT a.field, a.id AS id_a, b.id AS id_b FROM c a JOIN c b ON a.field = b.field AND a.canonical = b.canonical AND a.id < b.id AND a.raw <> b.raw",
    "p1_classes": _sql() + """, k AS (SELECT DISTINCT field, id, canonical, raw FROM c WHERE canonical IS NOT NULL), w AS (SELECT field, canonical, min(id) AS class_id, count(DISTINCT id) AS n FROM k GROUP BY ALL HAVING count(DISTINCT raw) > 1),
m AS (SELECT field, canonical, raw, count(*) AS m FROM k GROUP BY ALL) SELECT k.field, k.id, w.class_id, max(w.n - m.m) AS links FROM k JOIN w ON w.field = k.field AND w.canonical = k.canonical JOIN m ON m.field = k.field AND m.canonical = k.canonical AND m.raw = k.raw GROUP BY ALL""",
    "p1_canonical": _sql() + "SELECT field, id, canonical FROM c",
}
