"""Problem 6: fill containers of fixed capacity with items, best fit decreasing.

The order of best fit decreasing depends on sizes only, so it is run on the histogram of
sizes, which has at most capacity + 1 rows whatever the number of items. A segment tree over
remaining capacities finds the tightest open container in logarithmic time; all containers
with the same rest are filled as one group. The result is a list of ranges: items of size s
with ranks [from, to) go to containers from a number on, q in each. Items then get their rank
within their size and meet their range, so no task sees more than a share of the items.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from groundset.session import checkpointed, table

RANK_BLOCK = 4096
ROWS_PER_SALT = 100_000


class RestTree:
    """Segment tree over the rests 0..capacity: which rests have open containers."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << max(1, capacity).bit_length()
        self.any = bytearray(2 * self.leaves)
        self.open: dict[int, deque[tuple[int, int]]] = {}

    def add(self, rest: int, first: int, n: int) -> None:
        """Containers first .. first+n-1 have this rest now."""
        self.open.setdefault(rest, deque()).append((first, n))
        i = rest + self.leaves
        while i and not self.any[i]:
            self.any[i] = 1
            i >>= 1

    def take(self, rest: int) -> tuple[int, int]:
        group = self.open[rest].popleft()
        if not self.open[rest]:
            i = rest + self.leaves
            self.any[i] = 0
            while i > 1 and not (self.any[i] or self.any[i ^ 1]):
                i >>= 1
                self.any[i] = 0
        return group

    def tightest(self, size: int) -> int:
        """The smallest rest of at least ``size`` that has an open container, or -1."""
        i = size + self.leaves
        if i >= 2 * self.leaves:
            return -1
        if self.any[i]:
            return size
        while i > 1:
            if not i & 1 and self.any[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return -1


def best_fit_decreasing(histogram: Iterable[tuple[int, int]], capacity: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(size, rank_from, rank_to, per_container, first_container, offset) for sizes of at most the capacity.

    The same containers as placing one item after the other: after an item went into the
    tightest container, that container is the tightest for the next one of the same size
    until it is full, so each container of a group takes as many as fit.
    """
    tree, used = RestTree(capacity), 0
    for size, left in sorted(histogram, reverse=True):
        rank = 0
        while left:
            rest = tree.tightest(size)
            if rest < 0:
                rest, q = capacity, left if size == 0 else capacity // size
                first, n = used, -(-left // q)
                used += n
            else:
                q = left if size == 0 else rest // size
                first, n = tree.take(rest)
            full = min(n, left // q)
            if full:
                yield size, rank, rank + full * q, q, first, capacity - rest
                tree.add(rest - q * size, first, full)
                rank, left = rank + full * q, left - full * q
            if full < n:
                more = first + full
                if left:  # fewer than q items are left: they end in one container
                    yield size, rank, rank + left, left, more, capacity - rest
                    tree.add(rest - left * size, more, 1)
                    rank, left, more = rank + left, 0, more + 1
                if more < first + n:
                    tree.add(rest, more, first + n - more)


def pack(items: DataFrame) -> DataFrame:
    """(group_id, item_id, piece_no, size, container, start) for items (group_id, item_id, size, capacity).

    An item within the capacity stays whole (piece 0). A larger one gives full pieces, each
    in a container of its own ('f' + item + piece), and a rest that is packed like an item.
    Items of size 0 go where there is an open container. Null sizes count as 0; rows with a
    null id, group or capacity, or a capacity under 1, give nothing; the ids of a group must differ.
    """
    base = items.where("group_id IS NOT NULL AND item_id IS NOT NULL AND capacity >= 1").select("group_id", "item_id", F.greatest(F.coalesce("size", F.lit(0)), F.lit(0)).cast("long").alias("total"), F.col("capacity").cast("long").alias("capacity"))
    base = base.withColumn("whole", F.when(F.col("total") > F.col("capacity"), F.floor(F.col("total") / F.col("capacity"))).otherwise(0).cast("long"))
    base = checkpointed(base.withColumn("size", F.col("total") - F.col("whole") * F.col("capacity")))
    full = base.where("whole > 0").select("group_id", "item_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1)).alias("piece_no"), F.col("capacity").alias("size"))
    full = full.select("group_id", "item_id", "piece_no", "size", F.concat(F.lit("f"), F.col("item_id").cast("string"), F.lit("."), F.col("piece_no").cast("string")).alias("container"), F.lit(0).cast("long").alias("start"))
    rest = base.where("whole = 0 OR size > 0").select("group_id", "item_id", F.col("whole").alias("piece_no"), "size", "capacity")

    # ranks within (group, size): hot sizes are spread over salts, whose counts give the offsets
    salts = max(8, -(-base.count() // ROWS_PER_SALT))
    rest = rest.withColumn("salt", F.pmod(F.xxhash64("item_id"), F.lit(salts)))
    counts = rest.groupBy("group_id", "capacity", "size", "salt").agg(F.count("*").alias("n"))
    offsets = counts.withColumn("offset", F.sum("n").over(Window.partitionBy("group_id", "size").orderBy("salt")) - F.col("n"))
    ranked = rest.withColumn("r", F.row_number().over(Window.partitionBy("group_id", "size", "salt").orderBy("item_id")) - 1)
    ranked = ranked.join(offsets.select("group_id", "size", "salt", "offset"), ["group_id", "size", "salt"]).withColumn("rank", F.col("r") + F.col("offset"))

    histogram = counts.groupBy("group_id", "capacity", "size").agg(F.sum("n").alias("n"))

    def run(h: pd.DataFrame) -> pd.DataFrame:
        cap = int(h["capacity"].iloc[0])
        rows = best_fit_decreasing(zip(h["size"].astype(int).tolist(), h["n"].astype(int).tolist()), cap)
        out = pd.DataFrame(list(rows), columns=["size", "rank_from", "rank_to", "per", "first", "offset"])
        out.insert(0, "group_id", h["group_id"].iloc[0])
        return out

    kind = dict(items.dtypes)["group_id"]
    ranges = histogram.groupBy("group_id").applyInPandas(run, f"group_id {kind}, size long, rank_from long, rank_to long, per long, first long, offset long")
    ranges = ranges.withColumn("block", F.explode(F.sequence(F.floor(F.col("rank_from") / RANK_BLOCK), F.floor((F.col("rank_to") - 1) / RANK_BLOCK)))).withColumnRenamed("offset", "at")
    placed = ranked.drop("offset").withColumn("block", F.floor(F.col("rank") / RANK_BLOCK)).join(ranges, ["group_id", "size", "block"]).where("rank >= rank_from AND rank < rank_to")
    k = F.col("rank") - F.col("rank_from")
    placed = placed.select("group_id", "item_id", "piece_no", "size", F.concat(F.lit("b"), (F.col("first") + F.floor(k / F.col("per"))).cast("string")).alias("container"), (F.col("at") + (k % F.col("per")) * F.col("size")).cast("long").alias("start"))
    return placed.unionByName(full)


def sft_items(records: DataFrame, configs: DataFrame) -> DataFrame:
    """(group_id, item_id, size, capacity): the records each packing config trains on, sizes in code points."""
    said = F.aggregate(F.flatten(F.transform(F.coalesce("messages", F.expr("filter(messages, x -> false)")), lambda m: F.coalesce(m["content"], F.expr("array()").cast("array<struct<type:string,text:string,image:string>>")))), F.lit(0), lambda a, b: a + F.coalesce(F.length(b["text"]), F.lit(0)))
    asked = F.when(F.col("messages").isNotNull(), said).otherwise(F.coalesce(F.length("prompt"), F.lit(0)))
    r = records.select("record_id", "data_path", (asked + F.coalesce(F.length("completion"), F.lit(0))).alias("size")).distinct()
    c = configs.where("packing AND max_length >= 1").select(F.col("config_id").alias("group_id"), F.col("train_path").alias("data_path"), F.col("max_length").alias("capacity"))
    return r.join(c, "data_path").select("group_id", F.col("record_id").alias("item_id"), "size", "capacity")


def p6_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every record of a packing config goes."""
    items = sft_items(table(spark, sf_dir, "sft_records"), table(spark, sf_dir, "run_configs"))
    return pack(items).withColumnsRenamed({"group_id": "config_id", "item_id": "record_id"})


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers, characters and the share of space left unused, by config."""
    out = p6_containers(spark, sf_dir)
    per = out.groupBy("config_id", "container").agg(F.sum("size").alias("used"), F.count("*").alias("items"))
    cap = table(spark, sf_dir, "run_configs").select("config_id", F.col("max_length").cast("long").alias("capacity"))
    agg = per.groupBy("config_id").agg(F.count("*").alias("containers"), F.sum("items").alias("items"), F.sum("used").alias("characters"))
    return agg.join(cap, "config_id").select("config_id", "containers", "items", "characters", (1 - F.col("characters") / (F.col("containers") * F.col("capacity"))).alias("unused"))


def p6_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By config: items and characters that came out, containers over capacity, items within the capacity that were split, and pieces that lie over another."""
    out = p6_containers(spark, sf_dir)
    cap = F.broadcast(table(spark, sf_dir, "run_configs").select("config_id", F.col("max_length").cast("long").alias("capacity")))  # a control table
    last = F.lag(F.col("start") + F.col("size")).over(Window.partitionBy("config_id", "container").orderBy("start", F.col("start") + F.col("size")))
    per = out.withColumn("over", (last > F.col("start")).cast("int")).groupBy("config_id", "container").agg(F.sum("size").alias("used"), F.sum("over").alias("over")).join(cap, "config_id")
    boxes = per.groupBy("config_id").agg(F.count_if(F.col("used") > F.col("capacity")).alias("overfull"), F.coalesce(F.sum("over"), F.lit(0)).alias("overlapping"))
    item = out.groupBy("config_id", "record_id").agg(F.sum("size").alias("size"), F.count("*").alias("pieces")).join(cap, "config_id")
    items = item.groupBy("config_id").agg(F.count("*").alias("items"), F.sum("size").alias("characters"), F.count_if((F.col("size") <= F.col("capacity")) & (F.col("pieces") > 1)).alias("split"))
    return items.join(boxes, "config_id")


_SIZE = "coalesce(CASE WHEN messages IS NOT NULL THEN list_sum(list_transform(flatten(list_transform(messages, lambda m: coalesce(m.content, []))), lambda c: coalesce(length(c.text), 0))) ELSE length(prompt) END, 0) + coalesce(length(completion), 0)"
QUERIES = {"p6_containers": p6_containers, "p6_report": p6_report, "p6_checks": p6_checks}
ORACLE = {
    "p6_checks": f"""SELECT c.config_id, count(*) AS items, CAST(sum(r.size) AS BIGINT) AS characters, CAST(0 AS BIGINT) AS split, CAST(0 AS BIGINT) AS overfull, CAST(0 AS BIGINT) AS overlapping
FROM run_configs c JOIN (SELECT DISTINCT record_id, data_path, {_SIZE} AS size FROM sft_records) r ON r.data_path = c.train_path WHERE c.packing AND c.max_length >= 1 GROUP BY c.config_id""",
}
