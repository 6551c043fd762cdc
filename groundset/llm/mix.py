"""Problem 9: mix sources to target shares of all tokens.

Sainte-Laguë apportionment gives each source a whole number of equal blocks of tokens, by
highest quotients; the blocks of a source are apportioned to its shards the same way. Inside
a shard the documents stand in a seeded order, which is cut into blocks; the first so many of
them are taken, after as many whole repeats as the quota holds.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator, Sequence
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from groundset.session import checkpointed, small_rows, table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits text before the merges of the rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK_TOKENS = 64
ROWS_PER_SHARD = 100_000
MAX_SOURCES = 100_000
_encoders: dict[str, object] = {}


def encoder(vocabulary: str, content: bytes | None = None):
    """The byte-pair encoder of a rank file, made once in a process; ``content``: what the file holds, where it can't be read."""
    if vocabulary not in _encoders:
        import tiktoken

        lines = (Path(vocabulary).read_bytes() if content is None else content).splitlines()
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        _encoders[vocabulary] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[vocabulary]


def count_tokens(df: DataFrame, text: str, vocabulary: str = VOCABULARY, run_chars: int = 100_000) -> DataFrame:
    """(all columns but the text, tokens): sizes of whole texts; 0 for null and empty ones.

    A text longer than ``run_chars`` is counted in runs that end before a blank, where the
    pattern cuts anyway, so the count stays the same and no single call grows too large.
    """
    keep = [c for c in df.columns if c not in (text, "tokens")]
    shared = df.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())  # one rank file, some megabytes; workers need not have it

    def size(encode, s: str) -> int:
        total, at = 0, 0
        while len(s) - at > run_chars:
            cut = at + run_chars
            # a letter before and one blank with a letter behind: the pattern starts a new unit at this blank
            while cut < len(s) - 1 and not (s[cut] == " " and s[cut - 1].isalpha() and s[cut + 1].isalpha()):
                cut += 1
            if cut >= len(s) - 1:
                break
            total += len(encode(s[at:cut]))
            at = cut
        return total + len(encode(s[at:]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, shared.value).encode_ordinary
        for b in batches:
            n = [0 if s is None else size(encode, s) for s in b.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(n, pa.int64())], [*keep, "tokens"])

    from pyspark.sql import types as T

    return df.select(*keep, text).mapInArrow(run, T.StructType([df.schema[c] for c in keep] + [T.StructField("tokens", T.LongType())]))


def sainte_lague(weights: Sequence[float], seats: int, most: Sequence[int]) -> list[int]:
    """Seats by highest quotients weight / (2 k + 1), none above ``most``; ties go to the earlier one.

    The result of giving seats one by one, reached from a first guess near it, so the work
    doesn't depend on the number of seats. Fewer seats are given if ``most`` allows no more.
    """
    live = [i for i, w in enumerate(weights) if w > 0 and most[i] > 0]
    out = [0] * len(weights)
    seats = min(seats, sum(most[i] for i in live))
    if not live or seats <= 0:
        return out
    free, left = list(live), seats
    while free:  # sources at their limit leave their seats to the others
        total = sum(weights[i] for i in free)
        over = [i for i in free if weights[i] / total * left > most[i] + 1]
        if not over:
            break
        for i in over:
            out[i], left = most[i], left - most[i]
            free.remove(i)
    total = sum(weights[i] for i in free) or 1.0
    for i in free:
        out[i] = min(most[i], max(0, int(weights[i] / total * left) - 1))
    gap = seats - sum(out)
    while gap < 0:  # only if the guess was too high
        i = min((i for i in live if out[i]), key=lambda i: (weights[i] / (2 * out[i] - 1), -i))
        out[i], gap = out[i] - 1, gap + 1
    heap = [(-weights[i] / (2 * out[i] + 1), i) for i in live if out[i] < most[i]]
    heapq.heapify(heap)
    while gap and heap:
        _, i = heapq.heappop(heap)
        out[i], gap = out[i] + 1, gap - 1
        if out[i] < most[i]:
            heapq.heappush(heap, (-weights[i] / (2 * out[i] + 1), i))
    return out


def apportion(targets: list[tuple[str, float, int]], supply: dict[str, int], block: int) -> dict[str, tuple[int, int]]:
    """source -> (blocks, tokens a block). The total is the largest at which every source that has text can reach its share."""
    live = [(s, w, r) for s, w, r in targets if supply.get(s, 0) > 0 and w > 0 and r > 0]
    if not live:
        return {}
    weight = sum(w for _, w, _ in live)
    total = min(supply[s] * r * weight / w for s, w, r in live)
    most = [supply[s] * r // block for s, _, r in live]
    seats = sainte_lague([w for _, w, _ in live], int(total // block), most)
    return {s: (q, block) for (s, _, _), q in zip(live, seats)}


def shard_quotas(blocks: int, size: int, supply: list[int], repeats: int) -> list[int]:
    """The tokens each shard of a source gives: whole blocks by highest quotients of the supplies, and never more than a shard has under its repeats.

    A shard may get the block its last tokens only begin, so none of the source's blocks is lost to rounding.
    """
    quota = sainte_lague(supply, blocks, [-(-s * repeats // size) for s in supply])
    return [min(q * size, s * repeats) for q, s in zip(quota, supply)]


def mixture(sizes: DataFrame, targets: DataFrame, seed: int = 7, block: int = BLOCK_TOKENS) -> tuple[DataFrame, dict[str, tuple[int, int]]]:
    """(doc_id, source, tokens, copies) with copies >= 1, and the blocks of each source.

    sizes: doc_id, source, tokens. Documents without a source or a target, and those of no
    tokens, aren't taken; a source without documents gets nothing and its share goes to the
    others in proportion; no document has more than max_repeats copies; equal seeds give
    equal results.
    """
    wanted = [(r["source"], float(r["target_share"] or 0), int(r["max_repeats"] or 0)) for r in small_rows(targets.where("source IS NOT NULL"), MAX_SOURCES, "mix_targets")]
    docs = sizes.where("source IS NOT NULL AND tokens > 0 AND doc_id IS NOT NULL").select("doc_id", "source", "tokens")
    docs = docs.join(F.broadcast(docs.sparkSession.createDataFrame([(s,) for s, _, _ in wanted], "source string").distinct()), "source", "left_semi")  # at most MAX_SOURCES rows
    docs = checkpointed(docs)
    counts = docs.groupBy("source").agg(F.count("*").alias("n")).collect()  # at most MAX_SOURCES rows
    shards = docs.sparkSession.createDataFrame([(r["source"], -(-r["n"] // ROWS_PER_SHARD)) for r in counts], "source string, shards long")
    key = F.xxhash64(F.lit(seed), F.col("doc_id"))
    docs = docs.join(F.broadcast(shards), "source").withColumn("key", key).withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), F.col("doc_id")), F.col("shards")).cast("int")).drop("shards")
    per_shard = docs.groupBy("source", "shard").agg(F.sum("tokens").alias("supply"))
    supply = {r["source"]: r["n"] for r in per_shard.groupBy("source").agg(F.sum("supply").alias("n")).collect()}  # at most MAX_SOURCES rows
    blocks = apportion(wanted, supply, block)
    repeats = {s: r for s, _, r in wanted}

    def quotas(pdf: pd.DataFrame) -> pd.DataFrame:
        """The tokens of one source's blocks for each of its shards; its rows are the shards, one for ROWS_PER_SHARD of its documents."""
        source = pdf["source"].iloc[0]
        n, size = blocks.get(source, (0, 1))
        pdf = pdf.sort_values("shard")
        have = pdf["supply"].astype(int).tolist()
        return pd.DataFrame({"source": source, "shard": pdf["shard"], "supply": have, "want": shard_quotas(n, size, have, repeats[source])})

    q = per_shard.groupBy("source").applyInPandas(quotas, "source string, shard int, supply long, want long")
    w = Window.partitionBy("source", "shard").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    ranked = docs.withColumn("until", F.sum("tokens").over(w)).join(q, ["source", "shard"])
    base = F.floor(F.col("want") / F.col("supply"))
    more = F.col("want") - base * F.col("supply")
    copies = (base + F.when(F.col("until") - F.col("tokens") / 2 <= more, 1).otherwise(0)).cast("int")
    return ranked.select("doc_id", "source", "tokens", copies.alias("copies")).where("copies > 0"), blocks


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "text")


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the mixture with the number of copies of each."""
    return mixture(_sizes(spark, sf_dir), table(spark, sf_dir, "mix_targets"))[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of every source of mix_targets."""
    targets = table(spark, sf_dir, "mix_targets")
    mix, _ = mixture(_sizes(spark, sf_dir), targets)
    got = mix.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.count("*").alias("documents"), F.max("copies").alias("most_copies"))
    out = targets.select("source", "target_share", "max_repeats").join(got, "source", "left").fillna(0, ["tokens", "documents", "most_copies"])
    total = F.sum("tokens").over(Window.partitionBy())  # one row a source
    return out.withColumn("actual_share", F.when(total > 0, F.col("tokens") / total).otherwise(F.lit(0.0)))


def p9_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By target: whether its share is reached within half a percent of all tokens, and no document repeated too often. Shares of sources without documents go to the others."""
    s = p9_shares(spark, sf_dir).where("target_share > 0")
    live = F.sum(F.when(F.col("tokens") > 0, F.col("target_share"))).over(Window.partitionBy())  # one row a source
    want = F.when(F.col("tokens") > 0, F.col("target_share") / live).otherwise(0.0)
    return s.select("source", (F.abs(F.col("actual_share") - want) < 0.005).alias("reached"), (F.col("most_copies") <= F.col("max_repeats")).alias("kept"), (F.col("tokens") > 0).alias("used"))


QUERIES = {"p9_mixture": p9_mixture, "p9_shares": p9_shares, "p9_checks": p9_checks}
ORACLE = {
    "p9_checks": "SELECT m.source, TRUE AS reached, TRUE AS kept, m.source IN (SELECT source FROM documents WHERE text <> '' AND source IS NOT NULL) AS used FROM mix_targets m WHERE m.target_share > 0",
}
