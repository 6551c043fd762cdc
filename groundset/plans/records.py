"""Queries of records, pages and samples, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundset.functions.geometry import format_points
from groundset.functions.text import data_uri, strip_ansi, xml_attribute, xml_text
from groundset.operators import pages, preference, sampling
from groundset.session import table

CONFIG = ("config_id", "method", "train_path", "eval_path", "max_length", "packing", "chunk_overlap", "dataset_num_proc", "shuffle", "pad_to_multiple_of")
EXTENSIONS = ("bmp", "gif", "jpeg", "jpg", "png", "tif", "tiff", "webp")


def _said(col: str) -> F.Column:
    return F.array_join(F.transform(col, lambda m: F.concat(m["role"], F.lit(":"), F.array_join(F.transform(m["content"], lambda c: F.concat(c["type"], F.lit("="), F.coalesce(c["text"], F.lit("")))), "+"))), "|")


def _flat(df: DataFrame, key: str, *replies: str) -> DataFrame:
    return df.select(key, _said("prompt").alias("prompt"), *[_said(c).alias(c) for c in replies], F.array_join(F.transform("images", lambda i: i["path"]), ",").alias("images"), *[c for c in ("label",) if c in df.columns])


def _sft(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "sft_records")


def to_sft(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(preference.convert(_sft(spark, sf_dir), "sft", keep=("record_id",)), "record_id", "completion")


def to_dpo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(preference.convert(table(spark, sf_dir, "dpo_records"), "dpo", keep=("record_id",)), "record_id", "chosen", "rejected")


def _feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unpaired feedback: either answer of a pair with its label."""
    d = table(spark, sf_dir, "dpo_records")
    both = F.array(F.struct(F.col("chosen").alias("completion"), F.lit(True).alias("label")), F.struct(F.col("rejected").alias("completion"), F.lit(False).alias("label")))
    return d.select("record_id", "image", "prompt", F.explode(both).alias("x")).select("record_id", "image", "prompt", "x.*")


def to_kto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(preference.convert(_feedback(spark, sf_dir), "kto", keep=("record_id",)), "record_id", "completion")


def to_grpo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(preference.convert(_sft(spark, sf_dir), "grpo", keep=("record_id",)), "record_id")


def validate_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sft(spark, sf_dir).where("messages IS NOT NULL").select("record_id", F.coalesce(preference.message_defect(F.col("messages")), F.lit("")).alias("defect"))


def validate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken rows of either table by the method that reads them."""
    a = preference.rejects(_sft(spark, sf_dir), "sft", "record_id").withColumn("method", F.lit("sft"))
    b = preference.rejects(table(spark, sf_dir, "dpo_records"), "dpo", "record_id").withColumn("method", F.lit("dpo"))
    return a.unionByName(b)


def build_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = preference.with_prompt(_sft(spark, sf_dir))
    return p.select("record_id", F.size("prompt_messages").cast("long").alias("turns"), F.coalesce(F.size("images"), F.lit(0)).cast("long").alias("n_images"), F.try_element_at("prompt_messages", F.lit(-1))["role"].alias("last_role"))


def legacy_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _sft(spark, sf_dir).where("prompt IS NOT NULL")
    return p.select("record_id", _said_of(preference.legacy_prompt(F.col("image"), F.col("prompt"))).alias("said"))


def _said_of(messages: F.Column) -> F.Column:
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(":"), F.array_join(F.transform(m["content"], lambda c: F.concat(c["type"], F.lit("="), F.coalesce(c["text"], F.lit("")))), "+"))), "|")


def legacy_equiv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two input forms of one question give the same prompt."""
    p = _sft(spark, sf_dir).where("prompt IS NOT NULL AND image IS NOT NULL")
    block = lambda kind, text, image: F.struct(F.lit(kind).alias("type"), text.alias("text"), image.alias("image"))
    none = F.lit(None).cast("string")
    messages = F.array(F.struct(F.lit("user").alias("role"), F.array(block("image", none, F.col("image")), block("text", F.col("prompt"), none)).alias("content")))
    return p.select("record_id", (_said_of(preference.structured_prompt(messages)) == _said_of(preference.legacy_prompt(F.col("image"), F.col("prompt")))).alias("same"))


def sft_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The converted records of both tables, prompts and messages alike, as one supervised set."""
    a = preference.convert(_sft(spark, sf_dir), "sft", keep=("record_id",)).withColumn("origin", F.lit("sft"))
    d = table(spark, sf_dir, "dpo_records").select("record_id", "image", "prompt", F.col("chosen").alias("completion"))
    b = preference.convert(d, "sft", keep=("record_id",)).withColumn("origin", F.lit("dpo"))
    both = a.select("origin", "record_id", "prompt", "completion").unionByName(b.select("origin", "record_id", "prompt", "completion"))
    return both.select("origin", "record_id", F.md5(_said("prompt")).alias("prompt"), F.md5(_said("completion")).alias("completion"))


def reward_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sft(spark, sf_dir).select("record_id", preference.reward(F.col("completion")).alias("reward"))


def image_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.first_image(table(spark, sf_dir, "images"))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "regions").select("doc_id").distinct()


def missing_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).join(table(spark, sf_dir, "images").select(F.col("stem").alias("doc_id")), "doc_id", "left_anti")


def skip_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = pages.skip_reasons(_pages(spark, sf_dir), table(spark, sf_dir, "regions"), table(spark, sf_dir, "images"))
    return r.groupBy(F.coalesce("skip_reason", F.lit("")).alias("skip_reason")).agg(F.count("*").alias("pages"))


def transcription(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "regions").dropDuplicates(["doc_id", "region_no"])
    return pages.transcription_records(r, table(spark, sf_dir, "images"))


def nonblank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.nonblank(table(spark, sf_dir, "text_equivs").select("equiv_id", F.col("unicode").alias("text")), "text")


def reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "text_equivs").select("equiv_id", pages.reading_order(F.col("custom")).alias("reading_order"))


def transcription_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """region_line -> text of a page; of equal keys the later line counts."""
    t = table(spark, sf_dir, "text_equivs").where("equiv_index = 0 AND unicode IS NOT NULL").groupBy("doc_id", F.concat_ws("_", "region_id", "line_id").alias("line_key")).agg(F.max_by("unicode", F.struct("equiv_id", "ingested_at")).alias("text"))
    return t


def find_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "images").where(F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)).isin(*EXTENSIONS)).select("path")
    return sampling.shuffled(p, "path")


def sample_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    from groundset.operators.tasks import usable_regions

    r = usable_regions(table(spark, sf_dir, "regions")).select("doc_id", "region_no", F.posexplode("ls").alias("line_no", "l")).select("doc_id", "region_no", "line_no", F.col("l.text").alias("text")).distinct()
    return sampling.sample_global(r, ["doc_id", "region_no", "line_no"], 500)


def _lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where("source IS NOT NULL").select("source", "doc_id")


def sample_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.head_of_lists(_lists(spark, sf_dir), "source", "doc_id", fixed=20)


def sample_lists_relative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.head_of_lists(_lists(spark, sf_dir), "source", "doc_id", relative=0.25)


def strip_ansi_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("\x1b[31m"), F.col("text"), F.lit("\x1b[0m\x1b[1;32;40m")).alias("t"))
    return d.select("doc_id", strip_ansi(F.col("t")).alias("text"))


def xml_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(xml_text(F.col("text"))).alias("content"), F.md5(xml_attribute(F.col("text"))).alias("attribute"))


def config_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hash of each run's whole configuration, its keys in alphabetical order."""
    d = table(spark, sf_dir, "run_configs")
    value = lambda c: F.coalesce(F.concat(F.lit('"'), F.col(c), F.lit('"')) if dict(d.dtypes)[c] == "string" else F.col(c).cast("string"), F.lit("null"))
    js = F.concat(F.lit("{"), F.concat_ws(", ", *[F.concat(F.lit(f'"{c}": '), value(c)) for c in sorted(d.columns)]), F.lit("}"))
    return d.select("config_id", F.substring(F.sha1(js), 1, 8).alias("hash"))


def jsonl_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat rows written as JSON lines and read again, every hundredth broken, by defect and shape."""
    from groundset.sources.jsonl import typed_rows

    line = F.to_json(F.struct("image", "prompt", "messages", "completion"))
    raw = _sft(spark, sf_dir).select("record_id", F.when(F.col("record_id") % 100 == 0, F.concat(line, F.lit("}"))).otherwise(line).alias("raw"))
    t = typed_rows(raw)
    shape = F.coalesce("defect", F.when(F.col("messages").isNotNull(), "messages").when(F.col("prompt").isNotNull(), "prompt").otherwise("none"))
    return t.groupBy(shape.alias("shape")).agg(F.count("*").alias("lines"), F.sum(F.coalesce(F.length("completion"), F.lit(0))).alias("characters"))


def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by hour and type: what the streaming query computes, over the whole table."""
    from groundset.streaming.files import event_windows as windows

    return windows(table(spark, sf_dir, "events"), "ts").select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "events", F.round("total", 2).alias("total"))


def generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A caller's model over the names of customers: empty for every fifth, wrong for odd ones, so that it is asked again."""
    from groundset.operators.generate import generate

    def call(p: str) -> str:
        return "" if int(p[-9:]) % 5 == 0 else p.upper()

    d = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return generate(d, "c_custkey", "c_name", call, lambda out: "odd" if int(out[-9:]) % 2 else None, retries=3)


def rewarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two reward functions of a caller over the completions."""
    from groundset.operators.generate import rewards

    d = _sft(spark, sf_dir).select("record_id", F.coalesce("completion", F.lit("")).alias("completion")).distinct()
    return rewards(d, "record_id", "completion", [lambda s: s.str.len(), lambda s: s.str.endswith(".")])


def points_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corners of regions at a quarter of their size, as text with rounded numbers."""
    quarter = lambda x, y: F.struct((F.col(x) / 4).alias("x"), (F.col(y) / 4).alias("y"))
    r = table(spark, sf_dir, "regions").where("bbox IS NOT NULL").select("doc_id", "region_no", "bbox.*").distinct()
    return r.select("doc_id", "region_no", format_points(F.array(quarter("x1", "y1"), quarter("x2", "y2"))).alias("points"))


def data_uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of images as the contents of data URIs."""
    d = table(spark, sf_dir, "images").select("path", F.col("stem").cast("binary").alias("content"))
    return d.select("path", data_uri(F.col("path"), F.col("content")).alias("uri"))


def first_evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records an evaluation with a limit reads: the first twenty by id."""
    return _sft(spark, sf_dir).select("record_id").distinct().orderBy("record_id").limit(20)


QUERIES = {
    "generated": generated, "rewarded": rewarded, "points_format": points_format, "data_uris": data_uris, "first_evaluated": first_evaluated,
    "jsonl_scan": jsonl_scan, "event_windows": event_windows,
    "to_sft": to_sft, "to_dpo": to_dpo, "to_kto": to_kto, "to_grpo": to_grpo, "validate_messages": validate_messages, "validate_rows": validate_rows, "build_prompt": build_prompt, "legacy_prompt": legacy_prompt, "legacy_equiv": legacy_equiv,
    "sft_mix": sft_mix, "reward_default": reward_default, "image_lookup": image_lookup, "missing_images": missing_images, "skip_report": skip_report, "transcription": transcription, "nonblank_lines": nonblank_lines, "reading_order": reading_order,
    "transcription_map": transcription_map, "find_images": find_images, "sample_global": sample_global, "sample_lists": sample_lists, "sample_lists_relative": sample_lists_relative, "strip_ansi": strip_ansi_query, "xml_escape": xml_escape, "config_hash": config_hashes,
}

_M = "array_to_string(list_transform(messages, lambda m: m.role || ':' || array_to_string(list_transform(m.content, lambda c: c.type || '=' || CASE WHEN c.type = 'image' THEN '' ELSE coalesce(c.text, '') END), '+')), '|')"
_L = "'user:' || CASE WHEN coalesce(image, '') <> '' THEN 'image=+' ELSE '' END || 'text=' || prompt"
_I = "array_to_string(flatten(list_transform(messages, lambda m: list_transform(list_filter(m.content, lambda c: c.type = 'image'), lambda c: c.image))), ',')"
_P = f"CASE WHEN messages IS NOT NULL THEN {_M} ELSE {_L} END AS prompt, CASE WHEN messages IS NOT NULL THEN {_I} ELSE coalesce(image, '') END AS images"
_DEFECT = """CASE WHEN len(messages) < 1 THEN 'empty history' WHEN len(list_filter(messages, lambda m: m.role IS NULL OR m.role NOT IN ('system','user','assistant'))) > 0 THEN 'bad role'
 WHEN len(list_filter(messages, lambda m: m.content IS NULL OR len(list_filter(m.content, lambda c: c IS NULL OR c.type IS NULL)) > 0)) > 0 THEN 'bad content' WHEN messages[-1].role <> 'user' THEN 'last turn is not a user''s' END"""
_STRIP = "regexp_replace(unicode, '^[\\s\\x{0b}\\x{1c}-\\x{1f}\\x{85}\\pZ]+|[\\s\\x{0b}\\x{1c}-\\x{1f}\\x{85}\\pZ]+$', '', 'g')"
_RLINE = "(SELECT doc_id, region_no, unnest(lines) AS l, generate_subscripts(lines, 1) AS k FROM (SELECT DISTINCT doc_id, region_no, lines FROM regions))"
_PIC = "(SELECT stem AS doc_id, arg_min(path, ext || chr(1) || path) AS path FROM images WHERE stem IS NOT NULL GROUP BY stem)"
_URI = "CASE lower(regexp_extract(path, '\\.([A-Za-z0-9]+)$', 1)) WHEN 'jpg' THEN 'image/jpeg' WHEN 'jpeg' THEN 'image/jpeg' WHEN 'gif' THEN 'image/gif' WHEN 'webp' THEN 'image/webp' WHEN 'tif' THEN 'image/tiff' WHEN 'tiff' THEN 'image/tiff' WHEN 'bmp' THEN 'image/bmp' ELSE 'image/png' END"
ORACLE = {
    "generated": "SELECT c_custkey, CASE WHEN k % 5 <> 0 AND k % 2 = 0 THEN upper(c_name) END AS output, CAST(CASE WHEN k % 5 = 0 OR k % 2 = 0 THEN 1 ELSE 3 END AS INTEGER) AS attempts, CASE WHEN k % 5 = 0 THEN 'empty answer' WHEN k % 2 = 1 THEN 'odd' END AS error FROM (SELECT c_custkey, c_name, CAST(right(c_name, 9) AS BIGINT) AS k FROM customer)",
    "rewarded": "SELECT DISTINCT record_id, CAST(length(coalesce(completion, '')) AS DOUBLE) AS reward_0, CASE WHEN coalesce(completion, '') LIKE '%.' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS reward_1 FROM sft_records",
    "points_format": "SELECT DISTINCT doc_id, region_no, CAST(CAST(round_even(bbox.x1 / 4.0, 0) AS BIGINT) AS VARCHAR) || ',' || CAST(CAST(round_even(bbox.y1 / 4.0, 0) AS BIGINT) AS VARCHAR) || ' ' || CAST(CAST(round_even(bbox.x2 / 4.0, 0) AS BIGINT) AS VARCHAR) || ',' || CAST(CAST(round_even(bbox.y2 / 4.0, 0) AS BIGINT) AS VARCHAR) AS points FROM regions WHERE bbox IS NOT NULL",
    "data_uris": f"SELECT path, 'data:' || {_URI} || ';base64,' || base64(encode(stem)) AS uri FROM images",
    "first_evaluated": "SELECT DISTINCT record_id FROM sft_records ORDER BY record_id LIMIT 20",
    "jsonl_scan": "SELECT CASE WHEN record_id % 100 = 0 THEN 'malformed' WHEN messages IS NOT NULL THEN 'messages' WHEN prompt IS NOT NULL THEN 'prompt' ELSE 'none' END AS shape, count(*) AS lines, CAST(sum(CASE WHEN record_id % 100 = 0 THEN 0 ELSE coalesce(length(completion), 0) END) AS BIGINT) AS characters FROM sft_records GROUP BY 1",
    "event_windows": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS events, round(sum(value), 2) AS total FROM events GROUP BY ALL",
    "to_sft": f"SELECT record_id, {_P}, 'assistant:text=' || completion AS completion FROM sft_records WHERE (messages IS NOT NULL OR prompt IS NOT NULL) AND completion IS NOT NULL AND (messages IS NULL OR ({_DEFECT}) IS NULL)",
    "to_grpo": f"SELECT record_id, {_P} FROM sft_records WHERE (messages IS NOT NULL OR prompt IS NOT NULL) AND (messages IS NULL OR ({_DEFECT}) IS NULL)",
    "to_dpo": f"SELECT record_id, {_L} AS prompt, coalesce(image, '') AS images, 'assistant:text=' || chosen AS chosen, 'assistant:text=' || rejected AS rejected FROM dpo_records WHERE prompt IS NOT NULL AND chosen IS NOT NULL AND rejected IS NOT NULL",
    "to_kto": f"SELECT record_id, {_L} AS prompt, coalesce(image, '') AS images, 'assistant:text=' || c AS completion, label FROM (SELECT record_id, image, prompt, chosen AS c, TRUE AS label FROM dpo_records UNION ALL SELECT record_id, image, prompt, rejected, FALSE FROM dpo_records) WHERE prompt IS NOT NULL AND c IS NOT NULL",
    "validate_messages": f"SELECT record_id, coalesce({_DEFECT}, '') AS defect FROM sft_records WHERE messages IS NOT NULL",
    "validate_rows": f"""SELECT * FROM (SELECT record_id, CASE WHEN messages IS NULL AND prompt IS NULL THEN 'no messages or prompt' WHEN messages IS NOT NULL AND ({_DEFECT}) IS NOT NULL THEN {_DEFECT} WHEN completion IS NULL THEN 'no completion' END AS reason, 'sft' AS method FROM sft_records
UNION ALL SELECT record_id, CASE WHEN prompt IS NULL THEN 'no messages or prompt' WHEN chosen IS NULL THEN 'no chosen' WHEN rejected IS NULL THEN 'no rejected' END, 'dpo' FROM dpo_records) WHERE reason IS NOT NULL""",
    "build_prompt": "SELECT record_id, CAST(CASE WHEN messages IS NOT NULL THEN len(messages) ELSE 1 END AS BIGINT) AS turns, CAST(CASE WHEN messages IS NOT NULL THEN len(flatten(list_transform(messages, lambda m: list_filter(m.content, lambda c: c.type = 'image')))) WHEN coalesce(image, '') <> '' THEN 1 ELSE 0 END AS BIGINT) AS n_images, CASE WHEN messages IS NOT NULL THEN messages[-1].role ELSE 'user' END AS last_role FROM sft_records",
    "legacy_prompt": f"SELECT record_id, {_L} AS said FROM sft_records WHERE prompt IS NOT NULL",
    "legacy_equiv": "SELECT record_id, TRUE AS same FROM sft_records WHERE prompt IS NOT NULL AND image IS NOT NULL",
    "sft_mix": f"SELECT origin, record_id, md5(prompt) AS prompt, md5(completion) AS completion FROM (SELECT 'sft' AS origin, record_id, {_P}, 'assistant:text=' || completion AS completion FROM sft_records WHERE (messages IS NOT NULL OR prompt IS NOT NULL) AND completion IS NOT NULL AND (messages IS NULL OR ({_DEFECT}) IS NULL) UNION ALL SELECT 'dpo', record_id, {_L}, '', 'assistant:text=' || chosen FROM dpo_records WHERE prompt IS NOT NULL AND chosen IS NOT NULL)",
    "reward_default": "SELECT record_id, CASE WHEN coalesce(completion, '') <> '' THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS reward FROM sft_records",
    "image_lookup": f"SELECT doc_id AS stem, path FROM {_PIC}",
    "missing_images": "SELECT DISTINCT doc_id FROM regions WHERE doc_id NOT IN (SELECT stem FROM images WHERE stem IS NOT NULL)",
    "skip_report": f"""SELECT CASE WHEN t.doc_id IS NULL THEN 'no text' WHEN i.doc_id IS NULL THEN 'no image' ELSE '' END AS skip_reason, count(*) AS pages
FROM (SELECT DISTINCT doc_id FROM regions) p LEFT JOIN (SELECT DISTINCT doc_id FROM {_RLINE} WHERE trim(coalesce(l.text, '')) <> '') t ON t.doc_id = p.doc_id LEFT JOIN {_PIC} i ON i.doc_id = p.doc_id GROUP BY 1""",
    "transcription": f"""SELECT t.doc_id, 'Transcribe the text in this document.' AS prompt, t.completion, i.path FROM (SELECT doc_id, string_agg(l.text, E'\\n' ORDER BY l.reading_order IS NULL, l.reading_order, region_no, k) AS completion FROM {_RLINE} WHERE trim(coalesce(l.text, '')) <> '' GROUP BY doc_id) t JOIN {_PIC} i ON i.doc_id = t.doc_id""",
    "nonblank_lines": f"SELECT equiv_id, {_STRIP} AS text FROM text_equivs WHERE length({_STRIP}) > 0",
    "reading_order": "SELECT equiv_id, CAST(nullif(regexp_extract(coalesce(custom, ''), '^.*readingOrder \\{index:(\\d+);.*\\}', 1), '') AS INTEGER) AS reading_order FROM text_equivs",
    "transcription_map": "SELECT doc_id, region_id || '_' || line_id AS line_key, arg_max(unicode, equiv_id) AS text FROM text_equivs WHERE equiv_index = 0 AND unicode IS NOT NULL GROUP BY ALL",
    "find_images": "SELECT path, md5('42|' || path) AS draw FROM images WHERE lower(regexp_extract(path, '\\.([A-Za-z0-9]+)$', 1)) IN ('bmp','gif','jpeg','jpg','png','tif','tiff','webp')",
    "sample_global": """WITH l AS (SELECT doc_id, region_no, unnest(ls) AS l, generate_subscripts(ls, 1) - 1 AS line_no FROM (SELECT DISTINCT doc_id, region_no, list_filter(lines, lambda x: x.text IS NOT NULL AND trim(x.text) <> '' AND x.bbox IS NOT NULL AND x.bbox.x1 IS NOT NULL) AS ls FROM regions WHERE bbox IS NOT NULL AND page_w > 0 AND page_h > 0))
SELECT doc_id, region_no, CAST(line_no AS INTEGER) AS line_no, l.text AS text FROM l ORDER BY md5('42|' || doc_id || '|' || CAST(region_no AS VARCHAR) || '|' || CAST(line_no AS VARCHAR)), doc_id, region_no, line_no LIMIT 500""",
    "sample_lists": "SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents WHERE source IS NOT NULL) WHERE n <= 20",
    "sample_lists_relative": "SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n, count(*) OVER (PARTITION BY source) AS t FROM documents WHERE source IS NOT NULL) WHERE n <= floor(t * 0.25)",
    "strip_ansi": "SELECT doc_id, text FROM documents",
    "xml_escape": """SELECT doc_id, md5(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')) AS content, md5(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')) AS attribute FROM documents""",
    "config_hash": "SELECT config_id, substr(sha1('{' || " + " || ', ' || ".join(f"""'"{c}": ' || coalesce({f"'{chr(34)}' || {c} || '{chr(34)}'" if c.endswith("path") or c == "method" else f"CAST({c} AS VARCHAR)"}, 'null')""" for c in sorted(CONFIG)) + " || '}'), 1, 8) AS hash FROM run_configs",
}
