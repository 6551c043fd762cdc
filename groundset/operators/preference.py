"""Chat records: validation and the supervised, paired, unpaired and prompt-only forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLES = ("system", "user", "assistant")
BLOCKS = "array<struct<type:string,text:string>>"
METHODS = ("sft", "dpo", "kto", "grpo")


def block(kind: str, text: Column | None = None) -> Column:
    return F.struct(F.lit(kind).alias("type"), (F.lit(None).cast("string") if text is None else text).alias("text"))


def answer(text: Column) -> Column:
    """A reply as a list of one message."""
    return F.array(F.struct(F.lit("assistant").alias("role"), F.array(block("text", text)).alias("content")))


def message_defect(messages: Column) -> Column:
    """The first rule that a history breaks, or null: not empty, known roles, typed blocks, a user speaks last."""
    bad_role = F.exists(messages, lambda m: ~F.coalesce(m["role"].isin(*ROLES), F.lit(False)))
    bad_content = F.exists(messages, lambda m: m["content"].isNull() | F.coalesce(F.exists(m["content"], lambda c: c.isNull() | c["type"].isNull()), F.lit(True)))
    last = F.try_element_at(messages, F.lit(-1))["role"]
    return F.when(F.size(messages) < 1, "empty history").when(bad_role, "bad role").when(bad_content, "bad content").when(last != "user", "last turn is not a user's")


def row_defect(method: str, has: set[str]) -> Column:
    """The first rule that a row breaks for a method, or null. ``has`` are the columns of the table."""
    if method not in METHODS:
        raise ValueError(f"unknown method: {method}")
    c = lambda name: F.col(name) if name in has else F.lit(None)
    out = F.when(c("messages").isNull() & c("prompt").isNull(), "no messages or prompt") if "messages" in has else F.when(c("prompt").isNull(), "no messages or prompt")
    if "messages" in has:
        d = F.when(F.col("messages").isNotNull(), message_defect(F.col("messages")))
        out = out.when(d.isNotNull(), d)
    if method in ("sft", "kto"):
        out = out.when(c("completion").isNull(), "no completion")
    if method == "kto":
        out = out.when(c("label").isNull(), "label is not boolean")
    if method == "dpo":
        out = out.when(c("chosen").isNull(), "no chosen").when(c("rejected").isNull(), "no rejected")
    return out


def legacy_prompt(image: Column, prompt: Column) -> Column:
    """One user message: the image's place first, if there is an image, then the text."""
    return F.array(F.struct(F.lit("user").alias("role"), F.concat(F.when(F.coalesce(F.length(image), F.lit(0)) > 0, F.array(block("image"))).otherwise(F.expr(f"cast(array() as {BLOCKS})")), F.array(block("text", prompt))).alias("content")))


def structured_prompt(messages: Column) -> Column:
    """The history with images replaced by their places."""
    return F.transform(messages, lambda m: F.struct(m["role"].alias("role"), F.transform(m["content"], lambda c: F.struct(c["type"].alias("type"), F.when(c["type"] != "image", c["text"]).alias("text"))).alias("content")))


def image_paths(messages: Column, image: Column) -> Column:
    """The images of a record in order over all turns."""
    of = F.flatten(F.transform(messages, lambda m: F.transform(F.filter(m["content"], lambda c: c["type"] == "image"), lambda c: F.struct(c["image"].alias("path")))))
    none = F.expr("cast(array() as array<struct<path:string>>)")
    return F.when(messages.isNotNull(), of).when(F.coalesce(F.length(image), F.lit(0)) > 0, F.array(F.struct(image.alias("path")))).otherwise(none)


def with_prompt(rows: DataFrame) -> DataFrame:
    """Add prompt_messages and images; messages win over prompt."""
    has = set(rows.columns)
    image = F.col("image") if "image" in has else F.lit(None).cast("string")
    legacy = legacy_prompt(image, F.col("prompt"))
    if "messages" not in has:
        return rows.withColumn("prompt_messages", legacy).withColumn("images", F.when(F.coalesce(F.length(image), F.lit(0)) > 0, F.array(F.struct(image.alias("path")))).otherwise(F.expr("cast(array() as array<struct<path:string>>)")))
    return rows.withColumn("prompt_messages", F.when(F.col("messages").isNotNull(), structured_prompt(F.col("messages"))).otherwise(legacy)).withColumn("images", image_paths(F.col("messages"), image))


def convert(rows: DataFrame, method: str, strict: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records of one method. Broken rows are left out, or raise an error in strict mode; no row is shuffled."""
    defect = row_defect(method, set(rows.columns))
    if strict:
        ok = rows.withColumn("_defect", F.when(defect.isNotNull(), F.raise_error(F.concat(F.lit("bad row: "), defect))).otherwise(F.lit(None).cast("string"))).where("_defect IS NULL").drop("_defect")
    else:
        ok = rows.where(defect.isNull())
    made = with_prompt(ok)
    cols = [F.col(k) for k in keep] + [F.col("prompt_messages").alias("prompt")]
    if method in ("sft", "kto"):
        cols.append(answer(F.col("completion")).alias("completion"))
    if method == "dpo":
        cols += [answer(F.col("chosen")).alias("chosen"), answer(F.col("rejected")).alias("rejected")]
    if method == "kto":
        cols.append(F.col("label").cast("boolean").alias("label"))
    return made.select(*cols, "images")


def rejects(rows: DataFrame, method: str, key: str) -> DataFrame:
    """(key, reason) of the rows that convert leaves out."""
    return rows.select(F.col(key), row_defect(method, set(rows.columns)).alias("reason")).where("reason IS NOT NULL")


#: Method -> converter.
CONVERTERS = {m: (lambda m: lambda rows, **kw: convert(rows, m, **kw))(m) for m in METHODS}


def reward(completion: Column, want: Column | None = None) -> Column:
    """The default reward: 1 for an answer that isn't empty, 0 for an empty or null one."""
    return F.when(F.length(F.coalesce(completion, F.lit(""))) > 0, 1.0).otherwise(0.0)
