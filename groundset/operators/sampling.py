"""Deterministic samples: the order of a digest stands for a seeded shuffle, so every engine draws the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


PARTS = 64  # ways a list is parted, as one may hold a third of all rows


def draw(seed: int, *keys: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def sample_global(pool: DataFrame, keys: list[str], n: int, seed: int = 42) -> DataFrame:
    """n rows of a larger pool without replacement, all of a smaller one. A top-k, not a full sort."""
    return pool.orderBy(draw(seed, *keys), *keys).limit(n)


def head_of_lists(lists: DataFrame, name: str, order: str, fixed: int | None = None, relative: float | None = None) -> DataFrame:
    """The first rows of each list: a fixed number, or a share of its length cut to a whole number; the share wins if both are given."""
    if relative is None:  # the first ones of each part of a list, then of those
        part = lists.withColumn("_part", F.pmod(F.xxhash64(order), F.lit(PARTS)))
        for by in ((name, "_part"), (name,)):
            part = part.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(order))).where(F.col("_n") <= (fixed or 0))
        return part.drop("_n", "_part")
    # ranks from the counts of ranges of the order, so that no task sorts a whole list; keys that aren't numbers have one range
    size = lists.groupBy(name).agg(F.count("*").alias("_size"))
    number = dict(lists.dtypes)[order] in ("tinyint", "smallint", "int", "bigint", "float", "double")
    bounds = (lists.select(F.percentile_approx(order, [i / PARTS for i in range(1, PARTS)], 1000).alias("b")).first()["b"] or []) if number else []
    part = lists.withColumn("_part", F.size(F.filter(F.array(*map(F.lit, sorted(set(bounds)))), lambda b: b < F.col(order))) if bounds else F.lit(0))
    before = F.sum("_k").over(Window.partitionBy(name).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    counts = part.groupBy(name, "_part").agg(F.count("*").alias("_k")).withColumn("_before", F.coalesce(before, F.lit(0))).drop("_k")
    ranked = part.withColumn("_n", F.row_number().over(Window.partitionBy(name, "_part").orderBy(order))).join(counts, [name, "_part"]).join(size, name)
    return ranked.where(F.col("_n") + F.col("_before") <= (F.col("_size") * relative).cast("long")).select(*lists.columns)


def write_lists(heads: DataFrame, line: str, path: str) -> None:
    """The drawn lines as text files; what was there is replaced."""
    heads.select(F.col(line).cast("string")).write.mode("overwrite").text(path)


def shuffled(paths: DataFrame, path: str, seed: int = 42) -> DataFrame:
    """Paths with the digest whose order is the shuffle."""
    return paths.withColumn("draw", draw(seed, path))
