"""The structured markup: vocabulary, rendering from typed JSON, and its rules as queries over node tables."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from groundset.functions.text import strip
from groundset.operators.nested import load
from groundset.session import checkpointed

# The vocabulary, in its groups.
ROOT = ("doclang", "head", "default_resolution", "meta", "page_break")
SEMANTIC = ("text", "heading", "code", "formula", "caption", "page_header", "page_footer", "footnote", "list", "group", "field_region", "field_heading", "field_item", "key", "value", "picture", "table", "index")
FORMATTING = ("bold", "italic", "strikethrough", "underline", "superscript", "subscript", "rtl", "handwriting")
PAYLOAD = ("label", "thread", "xref", "href", "layer", "location", "description", "summary", "custom", "src", "tabular", "checkbox", "content")
STRUCTURAL = ("fcel", "ecel", "ched", "rhed", "corn", "srow", "lcel", "ucel", "xcel", "nl", "ldiv")
HINTS = ("marker", "hint")
VOCABULARY = ROOT + SEMANTIC + FORMATTING + PAYLOAD + STRUCTURAL + HINTS
CELLS = tuple(t for t in STRUCTURAL if t != "ldiv")
HEAD_ORDER = ("label", "thread", "xref", "href", "layer", "location", "caption", "description", "summary", "custom")
TOP_LEVEL = tuple(t for t in SEMANTIC if t != "caption")
#: Attributes with a closed set of values, and all attributes an element may have.
DOMAINS = {("layer", "value"): ("body", "background", "furniture"), ("checkbox", "class"): ("unselected", "selected"), ("list", "class"): ("ordered", "unordered"), ("picture", "class"): ("undefined", "chart"), ("value", "class"): ("read_only", "fillable")}
ATTRIBUTES = {"doclang": ("version",), "default_resolution": ("width", "height"), "label": ("value",), "thread": ("thread_id",), "xref": ("thread_id",), "href": ("uri",), "layer": ("value",), "location": ("value", "resolution"), "src": ("uri",), "checkbox": ("class",), "list": ("class",), "picture": ("class",), "value": ("class",), "heading": ("level",), "field_heading": ("level",)}
LEAST = {("thread", "thread_id"): 1, ("xref", "thread_id"): 1, ("heading", "level"): 1, ("field_heading", "level"): 1, ("location", "value"): 0, ("location", "resolution"): 1, ("default_resolution", "width"): 0, ("default_resolution", "height"): 0}
VERSION = "0.7"
PROMPT = "Transcribe this historical document into DocLang format."
NAMESPACE = "https://www.doclang.ai/ns/v0"
FIELDS = ("field_region", "field_item", "field_heading")
_INLINE = FORMATTING + ("content",)
_MIXED = _INLINE + HINTS + ("checkbox",)


def allowed_children() -> dict[str, tuple[tuple[str, ...], bool]]:
    """parent -> (child elements of its body, whether text may stand in it)."""
    rich = _MIXED + TOP_LEVEL
    out: dict[str, tuple[tuple[str, ...], bool]] = {t: (_INLINE, True) for t in FORMATTING + ("hint",)}
    out["marker"] = (_INLINE + ("checkbox",), True)
    out |= {t: (("content",), True) for t in ("description", "summary")}
    out |= {t: (rich, True) for t in ("text", "heading", "caption", "page_header", "page_footer", "footnote", "key", "value")}
    out["picture"] = (rich + ("src", "tabular"), True)
    out |= {t: (_MIXED + ("code", "formula", "picture", "field_region", "field_heading", "field_item", "key", "value"), True) for t in ("code", "formula")}
    out |= {t: (tuple(x for x in rich if x != "content"), True) for t in FIELDS}
    out["group"] = (TOP_LEVEL, False)
    out |= {t: (rich + CELLS, True) for t in ("table", "index", "tabular")}
    out["list"] = (rich + ("ldiv",), True)
    out["ldiv"] = (("marker",), False)
    out["doclang"] = (TOP_LEVEL + ("page_break", "head"), False)
    out["head"] = (("default_resolution", "meta"), False)
    out["content"] = ((), True)
    return out


# --- rendering -------------------------------------------------------------------------------

#: For each type: the fields that become attributes, and the fields whose elements follow the element head.
_ATTRS = {"thread": ("thread_id",), "xref": ("thread_id",), "href": ("uri",), "src": ("uri",), "label": ("value",), "layer": ("value",), "location": ("value", "resolution"), "checkbox": ("class",), "list": ("class",), "picture": ("class",), "value": ("class",), "heading": ("level",), "field_heading": ("level",), "default_resolution": ("width", "height")}
_BODY = {"list": ("items",), "table": ("cells",), "index": ("cells",), "tabular": ("cells",), "picture": ("src", "tabular", "body"), "ldiv": ("marker",), "head": ("items",)}
_SLOTS = (("label",), ("thread",), ("xref", "href"), ("layer",), ("locations",), ("caption",), ("description",), ("summary",), ("custom",))


_CLOSE = object()


def _many(value: object) -> list:
    return value if isinstance(value, list) else [] if value is None else [value]


def _quoted(value: object) -> str:
    return escape(value if isinstance(value, str) else json.dumps(value), {'"': "&quot;"})


def render(root: object) -> str:
    """Markup of typed objects, one or a list. An explicit stack of pieces, so depth is no limit.

    Objects of a list or table without a type (items, cells) give their separator, their head
    and their body. An unknown type is a ValueError.
    """
    out: list[str] = []
    stack: list[object] = [root]
    owners: list[str] = []  # kinds of the elements that are open
    while stack:
        node = stack.pop()
        if node is _CLOSE:
            owners.pop()
            continue
        if isinstance(node, str):
            out.append(node)
            continue
        if node is None:
            continue
        if isinstance(node, list):
            stack.extend(reversed(node))
            continue
        if not isinstance(node, dict):
            raise ValueError("neither object nor list")
        kind = node.get("type")
        head = node.get("head") or {}
        parts: list[object] = []
        for slot in _SLOTS:
            present = [x for name in slot for x in (_many(head.get(name)) if isinstance(head, dict) else [])]
            parts += present if slot == ("locations",) else present[:1]
        if kind is None:
            stack.extend(reversed([node.get("ldiv"), node.get("sep"), *parts, *_many(node.get("body"))]))
            continue
        if kind in ("text_chunk", "content"):
            text = node.get("text")
            if owners and owners[-1] in FIELDS and kind == "text_chunk" and not (text or "").strip():
                continue  # a blank run there would become an element that may not stand there
            bare = kind == "text_chunk" and (not text or text == text.strip())
            out.append(escape(text or "") if bare else f"<content>{escape(text)}</content>" if text is not None else "<content/>")
            continue
        if kind not in VOCABULARY:
            raise ValueError(f"unknown type: {kind}")
        attrs = "".join(f' {a}="{_quoted(node[a])}"' for a in _ATTRS.get(kind, ()) if node.get(a) is not None)
        inner = [*parts, *[x for f in _BODY.get(kind, ("body",)) for x in _many(node.get(f))]]
        empty = not inner and (kind in PAYLOAD + STRUCTURAL + ROOT and kind not in ("tabular", "description", "summary"))
        if empty:
            out.append(f"<{kind}{attrs}/>")
        else:
            out.append(f"<{kind}{attrs}>")
            owners.append(kind)
            stack += [_CLOSE, f"</{kind}>"]
            stack.extend(reversed(inner))
    return "".join(out)


def render_document(head: str | None, body: str | None, namespace: str = NAMESPACE) -> str | None:
    """Markup of a document from its JSON columns; None where the body is missing or can't be rendered. Lone surrogates become replacement signs."""
    try:
        b = load(body) if body else None
        h = load(head) if head else None
        if not isinstance(b, list):
            return None
        top = "" if h is None else f"<head>{render(_many(h.get('items')) if isinstance(h, dict) else [])}</head>"
        return f'<doclang xmlns="{namespace}" version="{VERSION}">{top}{render(b)}</doclang>'.encode("utf-8", "replace").decode()
    except (ValueError, TypeError, RecursionError):
        return None


def serialize(docs: DataFrame, key: str) -> DataFrame:
    """(doc_id, content): markup of head and body; rows that can't be rendered are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [(k, m) for k, h, t in zip(*(b.column(i).to_pylist() for i in range(3))) if (m := render_document(h, t)) is not None]
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*made)], ["doc_id", "content"])

    return docs.select(F.col(key).cast("string"), "head", "body").mapInArrow(run, "doc_id string, content string")


# --- rules -----------------------------------------------------------------------------------


def _found(df: DataFrame, rule: str, detail: Column) -> DataFrame:
    return df.select("doc_id", F.lit(rule).alias("rule"), "node_id", detail.cast("string").alias("detail"))


def _elements(nodes: DataFrame) -> DataFrame:
    return nodes.where("error IS NULL AND tag <> '#text'")


def _seen(text: Column) -> Column:
    """Something to read is in the text."""
    return F.length(strip(text)) > 0


def _if(condition: Column, detail: Column | str) -> Column:
    """The details of one finding, or none."""
    d = F.lit(detail) if isinstance(detail, str) else detail
    return F.when(condition, F.array(F.coalesce(d.cast("string"), F.lit("")))).otherwise(F.array().cast("array<string>"))


def _choice(of: Column, table: dict[str, list[str] | tuple[str, ...]]) -> Column:
    """The list of a fixed table for a tag, null if it has none."""
    return F.try_element_at(F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.array(*map(F.lit, v)) if v else F.array().cast("array<string>"))]), of)


def _node_rules() -> dict[str, Column]:
    """Rules that one node with what it lies in shows: name -> details of its findings."""
    tag, attrs, parent = F.col("tag"), F.col("attrs"), F.col("parent_tag")
    element = tag != "#text"
    kids = allowed_children()
    plain = [p for p, (_, mixed) in kids.items() if not mixed]
    domain = F.coalesce(*[F.when((tag == t) & ~attrs[a].isin(*vs), F.concat(F.lit(f"{t}@{a}="), attrs[a])) for (t, a), vs in DOMAINS.items()])
    extra = F.array_except(F.coalesce(F.map_keys("attrs"), F.array().cast("array<string>")), F.coalesce(_choice(tag, ATTRIBUTES), F.array().cast("array<string>")))
    number = lambda t, a, least: F.when((tag == t) & attrs[a].isNotNull() & (F.coalesce(attrs[a].try_cast("int"), F.lit(least - 1)) < least), F.concat(F.lit(f"{a}="), attrs[a]))
    allowed = _choice(parent, {p: cs for p, (cs, _) in kids.items()})
    return {
        "known_elements": _if(element & ~tag.isin(*VOCABULARY), tag),
        "attribute_domain": _if(element & domain.isNotNull(), domain),
        "known_attributes": _if(element & (F.size(extra) > 0), F.array_join(extra, ",")),
        "whole_numbers": F.array_compact(F.array(*[number(t, a, n) for (t, a), n in LEAST.items()])),
        "version": _if((tag == "doclang") & attrs["version"].isNotNull() & (attrs["version"] != VERSION), attrs["version"]),
        "allowed_children": _if(element & (F.col("slot") == "body") & allowed.isNotNull() & ~F.array_contains(allowed, tag), F.concat_ws(">", parent, tag)),
        "no_text_here": _if(~element & parent.isin(*plain) & _seen(F.col("text")), parent),
        "field_item_place": _if((tag == "field_item") & F.col("region_id").isNull(), tag),
        "key_place": _if((tag == "key") & F.col("item_id").isNull(), tag),
        "tabular_place": _if((tag == "tabular") & ((parent != "picture") | (F.coalesce("parent_class", F.lit("")) != "chart")), parent),
        "list_start": _if((tag == "list") & (F.col("subtree_end") == F.col("node_id")), ""),
        "table_start": _if(tag.isin("table", "index", "tabular") & (F.col("subtree_end") == F.col("node_id")), ""),
    }


def _families(nodes: DataFrame) -> DataFrame:
    """One row for each element with children (node_id, owner): what the rules about siblings need."""
    tag, at = F.col("tag"), F.col("ordinal")
    head = (F.col("slot") == "head") & tag.isin(*HEAD_ORDER)
    body = ((tag != "#text") & (F.col("slot") == "body")) | ((tag == "#text") & _seen(F.col("text")))
    corner = F.struct("ordinal", F.col("attrs")["value"].try_cast("int").alias("v"), F.col("attrs")["resolution"].try_cast("int").alias("r"))
    rank = F.array_position(F.array(*map(F.lit, HEAD_ORDER)), tag)
    return nodes.where("error IS NULL AND parent_id IS NOT NULL").groupBy("doc_id", F.col("parent_id").alias("node_id")).agg(
        F.first("parent_tag").alias("owner"),
        F.count_if(head & (tag == "xref")).alias("xrefs"), F.count_if(head & (tag == "href")).alias("hrefs"),
        F.array_sort(F.collect_list(F.when(tag == "location", corner))).alias("ls"),
        F.array_sort(F.collect_list(F.when(head, F.struct("ordinal", rank.alias("rank"), "tag")))).alias("hs"),
        F.min_by("tag", F.when(body, at)).alias("first_kid"), F.min(F.when(body & (F.col("slot") == "body"), at)).alias("body_at"), F.max(F.when(tag == "src", at)).alias("src_at"),
        F.max(F.when(head, at)).alias("head_at"), F.min(F.when((tag == "#text") & _seen(F.col("text")), at)).alias("text_at"),
    )


def _family_rules() -> dict[str, Column]:
    """Rules about the children of an element: name -> details."""
    v = lambda i: F.get("ls", F.lit(i))["v"]
    four = F.size("ls") == 4
    turns = F.filter(F.transform("hs", lambda x, i: F.when((i > 0) & (F.get("hs", i - 1)["rank"] > x["rank"]), x["tag"])), lambda t: t.isNotNull())
    return {
        "one_link": _if((F.col("xrefs") > 0) & (F.col("hrefs") > 0), "xref and href"),
        "four_locations": _if(~F.size("ls").isin(0, 4), F.size("ls")),
        "box_order": _if(four & ((v(0) > v(2)) | (v(1) > v(3))), F.concat_ws(",", *[v(i).cast("string") for i in range(4)])),
        "head_order": turns,
        "list_start": _if((F.col("owner") == "list") & (F.coalesce("first_kid", F.lit("")) != "ldiv"), F.col("first_kid")),
        "table_start": _if(F.col("owner").isin("table", "index", "tabular") & ~F.coalesce("first_kid", F.lit("")).isin(*CELLS), F.col("first_kid")),
        "src_first": _if(F.col("src_at") > F.col("body_at"), "src"),
        "text_before_head": _if(F.col("text_at") < F.col("head_at"), ""),
    }


def _spread(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(doc_id, rule, node_id, detail) of several rules in one pass."""
    named = lambda name: lambda x: F.struct(F.lit(name).alias("rule"), x.alias("detail"))
    each = F.flatten(F.array(*[F.transform(d, named(name)) for name, d in rules.items()]))
    return df.select("doc_id", "node_id", F.explode(each).alias("x")).select("doc_id", "x.rule", "node_id", "x.detail")


def _corners(n: DataFrame) -> DataFrame:
    loc = _elements(n).where("tag = 'location'").select("doc_id", "parent_id", "ordinal", F.col("attrs")["value"].try_cast("int").alias("v"), F.col("attrs")["resolution"].try_cast("int").alias("r"))
    g = loc.groupBy("doc_id", F.col("parent_id").alias("node_id")).agg(F.array_sort(F.collect_list(F.struct("ordinal", "v", "r"))).alias("ls"))
    return g.where(F.size("ls") == 4)


def rule_location_limit(n: DataFrame) -> DataFrame:
    """Locations below the declared size of their axis, or their own resolution; nothing declared, nothing to break."""
    size = _elements(n).where("tag = 'default_resolution'").groupBy("doc_id").agg(F.min_by(F.struct(F.col("attrs")["width"].try_cast("int").alias("w"), F.col("attrs")["height"].try_cast("int").alias("h")), "node_id").alias("s"))
    c = _corners(n).join(size, "doc_id", "left")
    over = F.exists(F.transform("ls", lambda x, i: x["v"] >= F.coalesce(x["r"], F.when(i % 2 == 0, F.col("s.w")).otherwise(F.col("s.h")))), lambda b: F.coalesce(b, F.lit(False)))
    return _found(c.where(over), "location_limit", F.lit(""))


def rule_rectangular(n: DataFrame) -> DataFrame:
    """Rows end at nl; all rows of a table have as many cells."""
    c = _elements(n).where(F.col("tag").isin(*CELLS) & F.col("parent_tag").isin("table", "index", "tabular"))
    w = Window.partitionBy("doc_id", "parent_id").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    rows = c.withColumn("row", F.coalesce(F.count_if(F.col("tag") == "nl").over(w), F.lit(0))).where("tag <> 'nl'").groupBy("doc_id", "parent_id", "row").agg(F.count("*").alias("width"))
    bad = rows.groupBy("doc_id", F.col("parent_id").alias("node_id")).agg(F.min("width").alias("a"), F.max("width").alias("b")).where("a <> b")
    return _found(bad, "rectangular", F.concat_ws("-", "a", "b"))


def rule_xref_defined(n: DataFrame) -> DataFrame:
    t = n.where("tag = 'thread'").select("doc_id", F.col("attrs")["thread_id"].alias("thread")).distinct()
    x = n.where("tag = 'xref'").withColumn("thread", F.col("attrs")["thread_id"])
    return _found(x.join(t, ["doc_id", "thread"], "left_anti"), "xref_defined", F.col("thread"))


def rule_one_key(n: DataFrame) -> DataFrame:
    """At most one key whose nearest field_item is the item."""
    own = n.where("tag = 'key' AND item_id IS NOT NULL").groupBy("doc_id", F.col("item_id").alias("node_id")).agg(F.count("*").alias("n"))
    return _found(own.where("n > 1"), "one_key", F.col("n"))


def rule_thread_host(n: DataFrame) -> DataFrame:
    t = n.where("tag = 'thread'").select("doc_id", "node_id", F.col("attrs")["thread_id"].alias("thread"), "parent_tag")
    bad = t.groupBy("doc_id", "thread").agg(F.min("node_id").alias("node_id"), F.min("parent_tag").alias("a"), F.max("parent_tag").alias("b")).where("a <> b")
    return _found(bad, "thread_host", F.concat_ws("-", "a", "b"))


NODE_RULES = ("known_elements", "attribute_domain", "known_attributes", "whole_numbers", "version", "allowed_children", "no_text_here", "field_item_place", "key_place", "tabular_place")
FAMILY_RULES = ("one_link", "four_locations", "box_order", "head_order", "list_start", "table_start", "src_first", "text_before_head")
DOCUMENT_RULES = {"location_limit": rule_location_limit, "rectangular": rule_rectangular, "xref_defined": rule_xref_defined, "one_key": rule_one_key, "thread_host": rule_thread_host}
RULES = ("well_formed", *NODE_RULES, *FAMILY_RULES, *DOCUMENT_RULES)


def violations(nodes: DataFrame, rules: tuple[str, ...] = RULES) -> DataFrame:
    """(doc_id, rule, node_id, detail) of all rules, or of some; a document that can't be parsed breaks the rule well_formed.

    Rules about a node are one projection, those about siblings one aggregate by parent; only
    threads, items, rows of cells and sizes have passes of their own. The node table is written once.
    """
    unknown = set(rules) - set(RULES)
    if unknown:
        raise ValueError(f"unknown rules: {sorted(unknown)}")
    nodes = checkpointed(nodes)
    parts = []
    if "well_formed" in rules:
        parts.append(_found(nodes.where("error IS NOT NULL"), "well_formed", F.col("error")))
    if own := {k: c for k, c in _node_rules().items() if k in rules}:
        parts.append(_spread(nodes.where("error IS NULL"), own))
    if own := {k: c for k, c in _family_rules().items() if k in rules}:
        parts.append(_spread(_families(nodes), own))
    parts += [f(nodes) for k, f in DOCUMENT_RULES.items() if k in rules]
    return reduce(DataFrame.unionByName, parts)


def rejected(nodes: DataFrame) -> DataFrame:
    """(doc_id, error) of markup documents no text is taken from: an element with some but not four locations, or where it may not stand, spoils the whole file."""
    n = nodes.where("error IS NULL AND path LIKE '/doclang%'")
    own, kin = _node_rules(), _family_rules()
    found = _spread(n, {"allowed_children": own["allowed_children"]}).unionByName(_spread(_families(n), {"four_locations": kin["four_locations"]}))
    return found.groupBy("doc_id").agg(F.min("rule").alias("error"))


def valid_documents(docs: DataFrame, found: DataFrame) -> DataFrame:
    return docs.join(found.select("doc_id"), "doc_id", "left_anti")


def node_text(nodes: DataFrame, tag: str) -> DataFrame:
    """(doc_id, node_id, text): the text of elements from their bodies; heads, lists and tables inside give nothing.

    A run belongs to every element of the tag around it that lies in the same shut element
    (list, table or index) or holds none in between; those are found along the run's path, so
    runs meet elements by (document, path), not all with all of a document.
    """
    e = nodes.where(F.col("tag") == tag).select("doc_id", "node_id", "subtree_end", "depth", F.coalesce("shut_id", F.lit(-1)).alias("shut"))
    run = nodes.where("tag = '#text' AND slot = 'body'").select("doc_id", F.col("node_id").alias("k"), "text", F.coalesce("shut_id", F.lit(-1)).alias("shut"), F.explode(F.filter(F.sequence(F.lit(0), F.col("depth") - 1), lambda d: F.get(F.split("path", "/"), d + 1) == tag)).alias("depth"))
    inner = e.join(run, ["doc_id", "shut", "depth"]).where("k > node_id AND k <= subtree_end")
    t = inner.groupBy("doc_id", "node_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "text"))), lambda x: x["text"]), "").alias("text"))
    return e.select("doc_id", "node_id").join(t, ["doc_id", "node_id"], "left").select("doc_id", "node_id", F.coalesce("text", F.lit("")).alias("text"))


def text_pairs(nodes: DataFrame) -> DataFrame:
    """(doc_id, node_id, text, bbox): text elements at any depth with four locations of their own and something to read, stripped, in document order."""
    box = _corners(nodes).select("doc_id", "node_id", F.struct(*[F.col("ls")[i]["v"].alias(k) for i, k in enumerate(("x1", "y1", "x2", "y2"))]).alias("bbox"))
    t = node_text(nodes, "text").withColumn("text", strip(F.col("text"))).where(F.length("text") > 0)
    return t.join(box, ["doc_id", "node_id"])


def coverage(nodes: DataFrame) -> DataFrame:
    """(tag, used): the vocabulary and how many documents use each element."""
    used = _elements(nodes).groupBy("tag").agg(F.count_distinct("doc_id").alias("documents"))
    v = nodes.sparkSession.createDataFrame([(t,) for t in VOCABULARY], "tag string")
    return v.join(used, "tag", "left").select("tag", F.coalesce("documents", F.lit(0)).cast("long").alias("documents"))


# --- mutations -------------------------------------------------------------------------------


def _first(text: Column, pairs: list[tuple[str, str]]) -> Column:
    """Replace the first occurrence of the first of some strings that is there."""
    out = text
    for old, new in reversed(pairs):
        at = F.locate(old, text)
        out = F.when(at > 0, F.concat(F.substring(text, F.lit(1), at - 1), F.lit(new), F.substring(text, at + len(old), F.length(text)))).otherwise(out)
    return out


MUTATIONS = {
    "swap_tag": lambda t: F.when(t.contains("<footnote>"), F.regexp_replace(_first(t, [("<footnote>", "<page_header>")]), r"(?s)^(.*?)</footnote>", "$1</page_header>")).otherwise(F.regexp_replace(_first(t, [("<text>", "<footnote>")]), r"(?s)^(.*?)</text>", "$1</footnote>")),
    "bogus_value": lambda t: _first(t, [(f'<{e} {a}="{v}"', f'<{e} {a}="bogus"') for (e, a), vs in DOMAINS.items() for v in vs]),
    "drop_tag": lambda t: _first(t, [("<nl/>", ""), ("<ldiv/>", ""), ("<fcel/>", ""), ("<ecel/>", "")]),
    "reorder_head": lambda t: F.regexp_replace(t, r"(<thread [^>]*/>)(<layer[^>]*/>)", "$2$1"),
    "break_table": lambda t: _first(t, [("<ecel/>", "")]),
    "two_links": lambda t: _first(t, [("<href", '<xref thread_id="1"/><href')]),
}


def mutants(docs: DataFrame) -> DataFrame:
    """(doc_id, mutation, content): every mutation of every document that changes it."""
    each = F.array(*[F.struct(F.lit(k).alias("mutation"), f(F.col("content")).alias("m")) for k, f in MUTATIONS.items()])
    return docs.select("doc_id", "content", F.explode(each).alias("x")).where("x.m <> content").select("doc_id", "x.mutation", F.col("x.m").alias("content"))
