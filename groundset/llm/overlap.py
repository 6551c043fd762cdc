"""Problem 3: the same or nearly the same question about the same page in two splits.

Edit-distance segment join. An evaluation text of n characters may differ by k(n) edits; it
is cut into k(n)+1 segments, of which one must survive unchanged. A training text emits its
substrings only at the positions where such a segment can stand (both the left and the right
view of the position bound it), both sides meet on (page, protected parts, n, segment number,
segment), and a banded distance verifies what met.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundset.session import small_rows, table, written

MAX_EDITS = 5
CHARS_PER_EDIT = 6
#: Words of courtesy and emphasis that don't change a question.
COURTESY = "please|kindly|now|just|simply|exactly|carefully|precisely|task|thanks|thank you|bitte|jetzt|genau|einfach|sorgfältig|aufgabe|danke|exactement|maintenant|simplement|soigneusement|tâche|merci|vänligen|snälla|nu|bara|exakt|noggrant|uppgift|tack"
#: Words for the same thing in questions about pages.
SYNONYMS = (("leaf", "page"), ("folio", "page"), ("sheet", "page"), ("bounding box", "box"), ("rectangle", "box"), ("frame", "box"), ("writing", "text"), ("wording", "text"), ("reply in", "answer in"), ("respond in", "answer in"))
MAX_CONFIGS = 10_000


def page_key(path: Column) -> Column:
    """The page a path shows: its last part without extension, in lower case; null for null and empty paths."""
    return F.nullif(F.lower(F.regexp_extract(F.trim(path), r"([^/\\]+?)(\.[A-Za-z0-9]+)?$", 1)), F.lit(""))


def wording(text: Column) -> Column:
    """The question in one spelling: lower case, single blanks, one kind of bracket, no courtesy words, no end mark."""
    out = F.lower(F.regexp_replace(text, r"[\s ]+", " "))
    out = F.regexp_replace(F.regexp_replace(out, r"[(\[] ?", "["), r" ?[)\]]", "]")
    out = F.regexp_replace(out, r" ?, ?", ",")
    out = F.regexp_replace(F.concat(F.lit(" "), out), rf" ({COURTESY})[:,]?( ({COURTESY})[:,]?)*( |$)", " ")
    for a, b in SYNONYMS:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.regexp_replace(out, r'^ +|[ .?!:"]+$', "")


def protected(text: Column) -> Column:
    """What no small difference may touch: numbers, the quoted line and the target language."""
    low = F.lower(text)
    numbers = F.array_join(F.regexp_extract_all(low, F.lit(r"(\d+)")), ",")
    quoted = F.regexp_replace(F.regexp_extract(low, '"([^"]*)', 1), r"[^\p{L}\p{N}]+", "")
    language = F.array_join(F.regexp_extract_all(low, F.lit(r"\b(english|german|french|swedish|latin|deutsch|englisch|französisch|schwedisch|anglais|allemand|français|suédois)\b")), ",")
    return F.concat_ws("\x01", numbers, quoted, language)


def name_words(text: Column) -> Column:
    """Capitalised words after the first one, lower-cased; none if the whole text is in capitals."""
    words = F.split(F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " ")), " ")
    rest = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    caps = F.transform(F.filter(rest, lambda w: F.regexp_like(w, F.lit(r"^\p{Lu}"))), F.lower)
    return F.when(text == F.upper(text), F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(caps)))


def edits(n: Column) -> Column:
    """k(n), the edits allowed for an evaluation text of n characters."""
    return F.least(F.lit(MAX_EDITS), F.floor(n / CHARS_PER_EDIT).cast("int"))


def _segment(n: Column, i: Column) -> tuple[Column, Column]:
    """Start (from 1) and length of segment i (from 0) of a text of n characters."""
    m = edits(n) + 1
    q = F.floor(n / m).cast("int")
    longer = (n - q * m).cast("int")
    short = m - longer
    start = i * q + F.greatest(i - short, F.lit(0)) + 1
    return start.cast("int"), (q + F.when(i >= short, 1).otherwise(0)).cast("int")


def _eval_segments(text: Column) -> Column:
    n = F.length(text)

    def one(i: Column) -> Column:
        start, size = _segment(n, i)
        return F.struct(n.alias("n"), i.alias("i"), F.xxhash64(F.substring(text, start, size)).alias("h"))

    return F.transform(F.sequence(F.lit(0), edits(n)), one)


def _train_segments(text: Column) -> Column:
    size = F.length(text)

    def for_length(n: Column) -> Column:
        k, delta = edits(n), size - n

        def for_segment(i: Column) -> Column:
            start, length = _segment(n, i)
            low = F.greatest(start - i, start + delta - (k - i), F.lit(1))
            high = F.least(start + i, start + delta + (k - i), size - length + 1)
            at = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
            return F.transform(at, lambda p: F.struct(n.alias("n"), i.alias("i"), F.xxhash64(F.substring(text, p, length)).alias("h")))

        return F.flatten(F.transform(F.sequence(F.lit(0), k), for_segment))

    lengths = F.filter(F.sequence(F.greatest(size - MAX_EDITS, F.lit(0)), size + MAX_EDITS), lambda n: F.abs(size - n) <= edits(n))
    return F.array_distinct(F.flatten(F.transform(lengths, for_length)))


def config_pairs(configs: DataFrame) -> list[tuple[str, str]]:
    """The (train_path, eval_path) pairs of supervised configs; null and equal paths make no pair."""
    rows = small_rows(configs.where("method = 'sft' AND train_path IS NOT NULL AND eval_path IS NOT NULL AND train_path <> eval_path").select("train_path", "eval_path").distinct(), MAX_CONFIGS, "run_configs")
    return sorted((r[0], r[1]) for r in rows)


def questions(records: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(record_id, data_path, source, cls, page, guard, words, names): the questions under paths of the pairs, written once; equal questions about a page have one cls.

    Rows without an image, a prompt or an id give nothing, nor do blank prompts; repeated rows count once.
    """
    paths = sorted({p for pair in pairs for p in pair})
    wanted = F.broadcast(records.sparkSession.createDataFrame([(p,) for p in paths], "data_path string"))  # at most 2 * MAX_CONFIGS rows
    r = records.where(F.col("prompt").isNotNull() & F.col("image").isNotNull() & F.col("record_id").isNotNull()).join(wanted, "data_path", "left_semi")
    r = r.select("record_id", "data_path", (F.col("source") if "source" in records.columns else F.lit(None).cast("string")).alias("source"), page_key(F.col("image")).alias("page"), wording(F.col("prompt")).alias("words"), F.xxhash64(protected(F.col("prompt"))).alias("guard"), name_words(F.col("prompt")).alias("names"))
    r = r.where(F.col("page").isNotNull() & (F.col("words") != ""))
    return written(r.withColumn("cls", F.struct(F.xxhash64("page", "guard", "words", "names").alias("a"), F.hash("names", "words", "page").alias("b"))), "questions")


def linked_classes(r: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(eval_cls, train_cls): classes of questions that are the same or nearly so, about the same page. Only classes are compared, never their copies."""
    spark = r.sparkSession
    side = lambda ps: r.join(F.broadcast(spark.createDataFrame([(p,) for p in sorted(ps)], "data_path string")), "data_path", "left_semi").select("cls", "page", "guard", "words", "names").dropDuplicates(["cls"])
    e = side({b for _, b in pairs}).withColumnsRenamed({"cls": "eval_cls", "words": "ew", "names": "en"})
    t = side({a for a, _ in pairs}).withColumnsRenamed({"cls": "train_cls", "words": "tw", "names": "tn"})
    t = t.join(e.select("page", "guard").distinct(), ["page", "guard"], "left_semi")
    where = F.xxhash64("page", "guard").alias("at")
    es = e.select("eval_cls", "ew", "en", where, F.explode(_eval_segments(F.col("ew"))).alias("s")).select("*", "s.*").drop("s")
    ts = t.select("train_cls", "tw", "tn", where, F.explode(_train_segments(F.col("tw"))).alias("s")).select("*", "s.*").drop("s")
    met = es.join(ts, ["at", "n", "i", "h"]).select("eval_cls", "train_cls", "ew", "en", "tw", "tn").dropDuplicates(["eval_cls", "train_cls"])
    ea, ta = F.split(F.translate("ew", ".,?!:;\"'[]", " " * 10), " +"), F.split(F.translate("tw", ".,?!:;\"'[]", " " * 10), " +")
    changed = F.array_union(F.array_except(ea, ta), F.array_except(ta, ea))
    near = F.levenshtein("ew", "tw", MAX_EDITS)
    ok = met.where((near >= 0) & (near <= edits(F.length("ew"))) & ~F.arrays_overlap(changed, F.concat("en", "tn")))
    return ok.select("eval_cls", "train_cls")


def cross_split_classes(r: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(eval_path, train_path, eval_cls, train_cls, eval_class, train_class, eval_records, train_records): linked classes of one pair of paths, with the least record id and the number of records of each."""
    links = F.broadcast(r.sparkSession.createDataFrame(pairs, "train_path string, eval_path string"))  # at most MAX_CONFIGS rows
    size = r.groupBy("cls", "data_path").agg(F.min("record_id").alias("least"), F.count_distinct("record_id").alias("n"))
    e = size.withColumnsRenamed({"cls": "eval_cls", "data_path": "eval_path", "least": "eval_class", "n": "eval_records"})
    t = size.withColumnsRenamed({"cls": "train_cls", "data_path": "train_path", "least": "train_class", "n": "train_records"})
    return linked_classes(r, pairs).join(e, "eval_cls").join(links, "eval_path").join(t, ["train_cls", "train_path"])


def cross_split_pairs(records: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(train_id, eval_id): records with image and prompt whose page is the same and whose questions are the same or nearly so.

    records: record_id, data_path, source, image, prompt; other columns don't matter. The
    classes of equal questions are compared; the record pairs the result is defined on come
    from their members.
    """
    if not pairs:
        return records.sparkSession.createDataFrame([], "train_id long, eval_id long")
    r = questions(records, pairs)
    links = F.broadcast(records.sparkSession.createDataFrame(pairs, "train_path string, eval_path string"))  # at most MAX_CONFIGS rows
    member = r.select("cls", "data_path", "record_id").distinct()
    e = member.select(F.col("cls").alias("eval_cls"), F.col("data_path").alias("eval_path"), F.col("record_id").alias("eval_id"))
    t = member.select(F.col("cls").alias("train_cls"), F.col("data_path").alias("train_path"), F.col("record_id").alias("train_id"))
    full = linked_classes(r, pairs).join(e, "eval_cls").join(links, "eval_path").join(t, ["train_cls", "train_path"])
    return full.where("train_id <> eval_id").select("train_id", "eval_id").distinct()


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cross_split_pairs(table(spark, sf_dir, "sft_records"), config_pairs(table(spark, sf_dir, "run_configs")))
    return found.select(F.least("train_id", "eval_id").alias("id_a"), F.greatest("train_id", "eval_id").alias("id_b")).distinct()


def p3_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked classes of questions by the least record of each, with their sizes."""
    pairs = config_pairs(table(spark, sf_dir, "run_configs"))
    if not pairs:
        return spark.createDataFrame([], "eval_path string, train_path string, eval_class long, train_class long, eval_records long, train_records long")
    return cross_split_classes(questions(table(spark, sf_dir, "sft_records"), pairs), pairs).drop("eval_cls", "train_cls")


def p3_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping evaluation records and pairs by evaluation path and source ('' where the source is null), from the sizes of classes alone."""
    pairs = config_pairs(table(spark, sf_dir, "run_configs"))
    if not pairs:
        return spark.createDataFrame([], "eval_path string, source string, records long, pairs long")
    r = questions(table(spark, sf_dir, "sft_records"), pairs)
    n = cross_split_classes(r, pairs).groupBy(F.col("eval_cls").alias("cls"), F.col("eval_path").alias("data_path")).agg(F.sum("train_records").alias("n"))
    e = r.select("cls", "data_path", "record_id", F.coalesce("source", F.lit("")).alias("source")).distinct().join(n, ["cls", "data_path"])
    return e.groupBy(F.col("data_path").alias("eval_path"), "source").agg(F.count_distinct("record_id").alias("records"), F.sum("n").alias("pairs"))


def _sql() -> str:
    syn = "w"
    for a, b in SYNONYMS:
        syn = f"replace({syn}, '{a}', '{b}')"
    return f"""
WITH src AS (
  SELECT DISTINCT record_id, data_path, source, prompt, lower(regexp_extract(trim(image), '([^/\\\\]+?)(\\.[A-Za-z0-9]+)?$', 1)) AS page,
    lower(regexp_replace(prompt, '[\\s ]+', ' ', 'g')) AS low FROM sft_records WHERE prompt IS NOT NULL AND image IS NOT NULL),
a AS (SELECT *, ' ' || regexp_replace(regexp_replace(regexp_replace(low, '[(\\[] ?', '[', 'g'), ' ?[)\\]]', ']', 'g'), ' ?, ?', ',', 'g') AS w0 FROM src),
b AS (SELECT *, regexp_replace(w0, ' ({COURTESY})[:,]?( ({COURTESY})[:,]?)*( |$)', ' ', 'g') AS w FROM a),
c AS (SELECT *, regexp_replace({syn}, '^ +|[ .?!:"]+$', '', 'g') AS words,
  array_to_string(regexp_extract_all(low, '\\d+'), ',') || '|' || regexp_replace(regexp_extract(low, '"([^"]*)', 1), '[^\\pL\\pN]+', '', 'g') || '|' ||
  array_to_string(regexp_extract_all(low, '\\b(english|german|french|swedish|latin|deutsch|englisch|französisch|schwedisch|anglais|allemand|français|suédois)\\b'), ',') AS guard,
  CASE WHEN prompt = upper(prompt) THEN []::VARCHAR[] ELSE list_transform(list_filter(string_split(trim(regexp_replace(prompt, '[^\\pL\\pN]+', ' ', 'g')), ' ')[2:], lambda x: regexp_matches(x, '^\\p{{Lu}}')), lambda x: lower(x)) END AS names FROM b),
d AS (SELECT *, regexp_split_to_array(translate(words, '.,?!:;"''[]', '          '), ' +') AS toks FROM c WHERE words <> '' AND page <> ''),
cfg AS (SELECT DISTINCT train_path, eval_path FROM run_configs WHERE method = 'sft' AND train_path <> eval_path),
hit AS (SELECT DISTINCT t.record_id AS train_id, e.record_id AS eval_id, e.data_path AS eval_path, coalesce(e.source, '') AS source
  FROM cfg JOIN d t ON t.data_path = cfg.train_path JOIN d e ON e.data_path = cfg.eval_path AND e.page = t.page AND e.guard = t.guard
  WHERE t.record_id <> e.record_id AND levenshtein(e.words, t.words) <= least({MAX_EDITS}, length(e.words) // {CHARS_PER_EDIT})
  AND NOT list_has_any(list_concat(list_filter(e.toks, lambda x: NOT list_contains(t.toks, x)), list_filter(t.toks, lambda x: NOT list_contains(e.toks, x))), list_concat(e.names, t.names)))
"""


QUERIES = {"p3_found": p3_found, "p3_classes": p3_classes, "p3_report": p3_report}
ORACLE = {
    "p3_found": _sql() + "SELECT DISTINCT least(train_id, eval_id) AS id_a, greatest(train_id, eval_id) AS id_b FROM hit",
    "p3_classes": _sql() + """, q AS (SELECT min(record_id) OVER (PARTITION BY page, guard, words, names, data_path) AS rep, * FROM d)
SELECT e.data_path AS eval_path, t.data_path AS train_path, e.rep AS eval_class, t.rep AS train_class, count(DISTINCT e.record_id) AS eval_records, count(DISTINCT t.record_id) AS train_records FROM hit JOIN q e ON e.record_id = hit.eval_id JOIN q t ON t.record_id = hit.train_id JOIN cfg ON cfg.train_path = t.data_path AND cfg.eval_path = e.data_path GROUP BY ALL""",
    "p3_report": _sql() + "SELECT eval_path, source, count(DISTINCT eval_id) AS records, count(DISTINCT (train_id, eval_id)) AS pairs FROM hit GROUP BY ALL",
}
