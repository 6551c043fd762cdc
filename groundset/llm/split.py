"""Problem 7: cut items that are larger than a limit at natural boundaries, with overlap.

One regular expression with bounded quantifiers takes pieces of a text in order: its
alternatives are sorted by the strength of the boundary they end at, each takes as much as
the limit allows, the last falls back to single characters. Lookback over the pieces before
supplies the overlap. All of it is array functions; no text leaves the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundset.session import small_rows, table

#: What a piece may end at, strongest first: paragraph, line, sentence, clause, element of markup, blank.
BOUNDARIES = (r"(?<=\n[ \t]{0,9}\n)", r"(?<=\n)", r"(?<=[.!?…]['\"»”)\]]{0,2}\s)", r"(?<=[;:,–—]\s)", r"(?<=>)(?=<)", r"(?<=\s)")
MAX_CONFIGS = 10_000


def fill(limit: int, overlap: int) -> tuple[int, int, int]:
    """(most characters of own text of a later piece, least of a strong and of a weak cut)."""
    own = limit - overlap
    weak = min(own, max(1, overlap)) if overlap <= own // 2 else max(1, own // 2)
    return own, max(own // 2, weak), weak


def pattern(limit: int, overlap: int) -> str:
    """The expression for pieces of at most ``limit`` code points that share ``overlap`` with the one before."""

    def cuts(most: int, strong: int, weak: int) -> str:
        ways = [rf".{{1,{most}}}\z"]
        ways += [f".{{{strong},{most}}}{b}" for b in BOUNDARIES]
        ways += [rf".{{{weak},{most}}}(?<=\s)", rf".{{{weak},{most}}}(?!\p{{M}})", f".{{1,{most}}}"]
        return "|".join(ways)

    own, strong, weak = fill(limit, overlap)
    first = cuts(limit, max(limit // 2, min(overlap, limit), 1), max(weak, min(overlap, limit), 1))
    return rf"(?s)\A(?:{first})|\G(?:{cuts(own, strong, weak)})"


def own_pieces(text: Column, limit: int, overlap: int = 0) -> Column:
    """The pieces without their overlaps, in order; they join to the text."""
    return F.regexp_extract_all(text, F.lit(pattern(limit, overlap)), F.lit(0))


def with_overlaps(own: Column, overlap: Column, back: Column) -> Column:
    """Each piece after the first with the last ``overlap`` characters before it, which ``back`` pieces before hold.

    ``own`` must be a column that is there, not an expression: it is read once for each piece.
    """

    def one(piece: Column, i: Column) -> Column:
        before = F.array_join(F.slice(own, F.greatest(i - back + 1, F.lit(1)), F.least(i, back)), "")
        return F.when((i == 0) | (overlap == 0), piece).otherwise(F.concat(F.substring(before, -overlap, overlap), piece))

    return F.transform(own, one)


def lookback(limit: int, overlap: int) -> int:
    """So many pieces before hold at least ``overlap`` characters."""
    return math.ceil(overlap / fill(limit, overlap)[2]) if overlap else 0


def checked(limit: int, overlap: int | None) -> tuple[int, int]:
    if limit < 1:
        raise ValueError("the limit must be at least 1")
    return limit, min(max(overlap or 0, 0), limit - 1)


def pieces(df: DataFrame, text: str, limit: int, overlap: int | None = 0, to: str = "pieces") -> DataFrame:
    """Add the column ``to``: the ordered pieces of a text as an array of strings.

    Each has at most ``limit`` code points; piece k+1 starts with the last ``overlap`` code
    points of piece k; without the overlaps they join to the text again. A text within the
    limit is one piece, an empty text is no piece, null stays null. An overlap of the limit
    or more is taken as limit - 1; a limit under 1 is an error.
    """
    limit, overlap = checked(limit, overlap)
    cut = df.select("*", F.explode(F.array(own_pieces(F.col(text), limit, overlap))).alias("_own"))
    return cut.withColumn(to, with_overlaps(F.col("_own"), F.lit(overlap), F.lit(lookback(limit, overlap)))).drop("_own")


def split_configs(configs: DataFrame) -> list[tuple[int, str, int, int]]:
    """(config_id, train_path, max_length, overlap) of supervised configs with a limit of at least 1."""
    rows = small_rows(configs.where("method = 'sft' AND max_length >= 1 AND train_path IS NOT NULL AND config_id IS NOT NULL").select("config_id", "train_path", "max_length", F.coalesce("chunk_overlap", F.lit(0)).alias("o")).distinct(), MAX_CONFIGS, "run_configs")
    return sorted(tuple(r) for r in rows)


def split_records(records: DataFrame, configs: list[tuple[int, str, int, int]]) -> DataFrame:
    """(config_id, record_id, piece_no, text): the pieces of every completion that is too long for a config that trains on it.

    Null and short completions give nothing; deliveries of a record count once.
    """
    spark = records.sparkSession
    rows = [(cid, path, limit, overlap, lookback(limit, overlap), pattern(limit, overlap)) for cid, path, most, shared in configs for limit, overlap in (checked(most, shared),)]
    c = F.broadcast(spark.createDataFrame(rows, "config_id int, data_path string, most int, overlap int, back int, pattern string"))  # at most MAX_CONFIGS rows
    cut = records.select("record_id", "data_path", "completion").join(c, "data_path").where(F.length("completion") > F.col("most"))
    cut = cut.select("config_id", "record_id", "overlap", "back", F.explode(F.array(F.regexp_extract_all("completion", F.col("pattern"), F.lit(0)))).alias("own"))
    return cut.select("config_id", "record_id", F.posexplode(with_overlaps(F.col("own"), F.col("overlap"), F.col("back"))).alias("piece_no", "text"))


def p7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_records(table(spark, sf_dir, "sft_records"), split_configs(table(spark, sf_dir, "run_configs"))).dropDuplicates(["config_id", "record_id", "piece_no"])


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = split_records(table(spark, sf_dir, "sft_records"), split_configs(table(spark, sf_dir, "run_configs")))
    return cut.where("piece_no = 1 AND text IS NOT NULL").select("config_id", "record_id").distinct()


def p7_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the pieces of each record make again without their overlaps, and whether all keep the limit and share what they must."""
    c = table(spark, sf_dir, "run_configs").select("config_id", F.col("max_length").alias("most"), F.least(F.greatest(F.coalesce("chunk_overlap", F.lit(0)), F.lit(0)), F.col("max_length") - 1).alias("overlap"))
    p = p7_pieces(spark, sf_dir).groupBy("config_id", "record_id").agg(F.array_sort(F.collect_list(F.struct("piece_no", "text"))).alias("ps")).join(F.broadcast(c), "config_id")
    own = F.array_join(F.transform("ps", lambda x, i: F.when(i == 0, x["text"]).otherwise(F.substring(x["text"], F.col("overlap") + 1, F.length(x["text"])))), "")
    short = F.forall("ps", lambda x: (F.length(x["text"]) <= F.col("most")) & (F.length(x["text"]) > 0))
    shared = F.forall(F.transform("ps", lambda x, i: (i == 0) | (F.col("overlap") == 0) | F.endswith(F.get("ps", i - 1)["text"], F.substring(x["text"], F.lit(1), F.col("overlap")))), lambda ok: ok)
    return p.select("config_id", "record_id", F.md5(own).alias("whole"), (short & shared).alias("kept"))


QUERIES = {"p7_found": p7_found, "p7_pieces": p7_pieces, "p7_checks": p7_checks}
ORACLE = {
    "p7_checks": """SELECT DISTINCT c.config_id, r.record_id, md5(r.completion) AS whole, TRUE AS kept FROM run_configs c JOIN sft_records r ON r.data_path = c.train_path
WHERE c.method = 'sft' AND c.max_length IS NOT NULL AND length(r.completion) > c.max_length""",
    "p7_found": """SELECT DISTINCT c.config_id, r.record_id FROM run_configs c JOIN sft_records r ON r.data_path = c.train_path
WHERE c.method = 'sft' AND c.max_length IS NOT NULL AND length(r.completion) > c.max_length""",
}
