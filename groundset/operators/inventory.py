"""The markup's vocabulary in four forms, and how they are compared.

Rules, renderer, JSON schema and grammar each say which elements there are, which attributes
have a closed set of values, and what the root is. Schema and grammar are made here from the
tables the rules and the renderer use; their inventories are read back from the made text.
"""

from __future__ import annotations

import json
import re
from itertools import combinations
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundset.operators import markup as M

Inventory = set[tuple[str, str]]  # (kind, item): element, value (element@attribute=value), root


# --- JSON schema -----------------------------------------------------------------------------


def json_schema() -> dict[str, Any]:
    """The schema of a document as JSON: an object with head and body; one definition for each type of element, told apart by its constant ``type``."""
    kids = M.allowed_children()
    any_of = lambda names: {"anyOf": [{"$ref": f"#/$defs/{n}"} for n in names]}
    listed = lambda names: {"type": "array", "items": any_of(names)}
    text_chunk = {"type": "object", "properties": {"type": {"const": "text_chunk"}, "text": {"type": "string"}}, "required": ["type", "text"]}
    head = {"type": "object", "properties": {n if n != "location" else "locations": {"$ref": f"#/$defs/{n}"} if n != "location" else {"type": "array", "items": {"$ref": "#/$defs/location"}, "minItems": 4, "maxItems": 4} for n in M.HEAD_ORDER}}
    defs: dict[str, Any] = {"text_chunk": text_chunk, "element_head": head}
    for name in M.VOCABULARY:
        if name == "doclang":
            continue
        props: dict[str, Any] = {"type": {"const": name}}
        for attr in M.ATTRIBUTES.get(name, ()):
            values = M.DOMAINS.get((name, attr))
            props[attr] = {"enum": list(values)} if values else {"type": "integer", "minimum": M.LEAST[name, attr]} if (name, attr) in M.LEAST else {"type": "string"}
        if name in kids and kids[name][0] + ("text_chunk",) * kids[name][1]:
            if name in M.SEMANTIC:
                props["head"] = {"$ref": "#/$defs/element_head"}
            props[{"list": "items", "table": "cells", "index": "cells", "tabular": "cells", "head": "items"}.get(name, "body")] = listed(kids[name][0] + ("text_chunk",) * kids[name][1])
        if name == "content":
            props["text"] = {"type": "string"}
        defs[name] = {"type": "object", "properties": props, "required": ["type"]}
    root = {"type": "object", "title": "doclang", "properties": {"head": {"$ref": "#/$defs/head"}, "body": listed(kids["doclang"][0][:-1])}, "required": ["body"], "$defs": defs}
    return strict(root)


def strict(schema: Any, keep: tuple[str, ...] = ("title",)) -> Any:
    """A copy in which no object takes other fields, without words that constrain nothing (but those in ``keep``)."""
    if isinstance(schema, list):
        return [strict(x, keep) for x in schema]
    if not isinstance(schema, dict):
        return schema
    silent = {"default", "title", "description", "examples", "deprecated"} - set(keep)
    named = {"properties", "$defs"}  # under these, keys are names
    out = {k: {n: strict(x, keep) for n, x in v.items()} if k in named else strict(v, keep) for k, v in schema.items() if k not in silent}
    if out.get("type") == "object" or "properties" in out:
        out["additionalProperties"] = False
    return out


def response_format(name: str = "doclang", enforced: bool = False) -> dict[str, Any]:
    """The schema as a request for structured answers."""
    return {"type": "json_schema", "json_schema": {"name": name, "schema": strict(json_schema(), ()), "strict": enforced}}


def schema_inventory(schema: dict[str, Any]) -> Inventory:
    out: Inventory = {("root", schema["title"]), ("element", schema["title"])}
    for name, d in schema["$defs"].items():
        kind = d["properties"].get("type", {}).get("const")
        if kind is None or kind == "text_chunk":
            continue
        out.add(("element", kind))
        out |= {("value", f"{kind}@{a}={v}") for a, p in d["properties"].items() for v in p.get("enum", ())}
    return out


# --- grammar ---------------------------------------------------------------------------------


def grammar() -> str:
    """A context-free grammar of documents, one rule a line: ``name ::= alternatives``; literals in quotes."""
    kids = M.allowed_children()
    rule = lambda name: f"{name}-el"
    lines = [f'root ::= "<doclang xmlns=\\"" chars "\\" version=\\"" chars "\\">" {rule("head")}? ({" | ".join(rule(k) for k in kids["doclang"][0] if k != "head")})* "</doclang>"']
    lines += ["chars ::= [^<>&\"]*", "run ::= [^<>&]+", "number ::= \"-\"? [0-9]+"]
    lines.append(f"front ::= {' '.join(rule(n) + ('*' if n == 'location' else '?') for n in M.HEAD_ORDER)}")
    for name in M.VOCABULARY:
        if name == "doclang":
            continue
        attrs = []
        for a in M.ATTRIBUTES.get(name, ()):
            values = M.DOMAINS.get((name, a))
            kind = f"{name}-{a.replace('_', '-')}"
            attrs.append(f'(" {a}=\\"" {kind} "\\"")?')
            lines.append(f"{kind} ::= {' | '.join(json.dumps(v) for v in values) if values else 'number' if (name, a) in M.LEAST else 'chars'}")
        inner, mixed = kids.get(name, ((), False))
        body = " | ".join([*map(rule, inner), *(["run"] if mixed else [])])
        parts = [f'"<{name}"', *attrs]
        empty = '"/>"'
        full = f'">" {"front " if name in M.SEMANTIC else ""}{f"({body})* " if body else ""}"</{name}>"'
        lines.append(f"{rule(name)} ::= {' '.join(parts)} ({empty} | {full})")
    return "\n".join(lines)


def lark(text: str) -> str:
    """The grammar in the dialect of another generator of parsers: colons, character classes as patterns, names with underscores, the start rule called start."""
    out = []
    for line in text.splitlines():
        name, _, body = line.partition(" ::= ")
        parts = re.split(r'("(?:[^"\\]|\\.)*")', body)
        for i in range(0, len(parts), 2):
            parts[i] = re.sub(r"\[((?:[^\]\\]|\\.)*)\]([*+?]?)", r"/[\1]\2/", parts[i]).replace("-", "_") if "[" not in parts[i] else re.sub(r"\[((?:[^\]\\]|\\.)*)\]([*+?]?)", r"/[\1]\2/", parts[i])
        out.append(f"{'start' if name == 'root' else name.replace('-', '_')}: {''.join(parts)}")
    return "\n".join(out)


def grammar_inventory(text: str) -> Inventory:
    """Elements from the opening literals, values from rules of literals only, the root from what the root rule opens."""
    rules = dict(line.split(" ::= ", 1) for line in text.splitlines())
    out: Inventory = set()
    for name, body in rules.items():
        out |= {("element", t) for t in re.findall(r'"<([a-z_]+)', body)}
        if re.fullmatch(r'"[^"]*"(?: \| "[^"]*")*', body) and (m := re.fullmatch(r"([a-z_]+)-([a-z-]+)", name)):
            out |= {("value", f"{m[1]}@{m[2].replace('-', '_')}={v}") for v in re.findall(r'"([^"]*)"', body)}
    out |= {("root", t) for t in re.findall(r'^"<([a-z_]+)', rules["root"])}
    return out


def inferred_root(edges: DataFrame) -> DataFrame:
    """(root): of the elements no other one refers to, that which refers to most. edges: parent, child."""
    own = edges.where("parent <> child").select("parent", "child").distinct()
    top = own.join(own.select(F.col("child").alias("parent")), "parent", "left_anti").groupBy("parent").agg(F.count("*").alias("n"))
    return top.agg(F.max_by("parent", F.struct("n", "parent")).alias("root"))


def child_edges(spark: SparkSession) -> DataFrame:
    """(parent, child) of the table of allowed children and of the parts of element heads."""
    rows = [(p, c) for p, (cs, _) in M.allowed_children().items() for c in cs] + [(p, c) for p in M.SEMANTIC for c in M.HEAD_ORDER]
    return spark.createDataFrame(rows, "parent string, child string")


# --- comparison ------------------------------------------------------------------------------


def rules_inventory() -> Inventory:
    return {("element", t) for t in M.VOCABULARY} | {("value", f"{t}@{a}={v}") for (t, a), vs in M.DOMAINS.items() for v in vs} | {("root", "doclang")}


def renderer_inventory() -> Inventory:
    """What the renderer makes of one object of every type with every value, read back from its markup."""
    out: Inventory = set()
    for name in M.VOCABULARY:
        if name == "doclang":
            continue
        for value in (None, *(v for (t, _), vs in M.DOMAINS.items() if t == name for v in vs)):
            attr = next((a for t, a in M.DOMAINS if t == name), None)
            text = M.render({"type": name, **({attr: value} if attr and value else {})})
            out |= {("element", t) for t in re.findall(r"<([a-z_]+)", text)}
            out |= {("value", f"{name}@{a}={v}") for a, v in re.findall(r' ([a-z_]+)="([^"]*)"', text)}
    top = M.render_document(None, "[]") or ""
    return out | {(k, t) for t in re.findall(r"^<([a-z_]+)", top) for k in ("root", "element")}


def inventories(spark: SparkSession) -> DataFrame:
    """(source, kind, item) of all four."""
    made = {"rules": rules_inventory(), "renderer": renderer_inventory(), "schema": schema_inventory(json_schema()), "grammar": grammar_inventory(grammar())}
    return spark.createDataFrame([(s, k, i) for s, items in made.items() for k, i in sorted(items)], "source string, kind string, item string")


def differences(items: DataFrame) -> DataFrame:
    """(one, other, kind, item): what one source has and another lacks, for every two of them."""
    names = sorted(r["source"] for r in items.select("source").distinct().limit(100).collect())
    of = lambda s: items.where(F.col("source") == s).select("kind", "item")
    out = items.select(F.col("source").alias("one"), F.col("source").alias("other"), "kind", "item").limit(0)
    for a, b in combinations(names, 2):
        for x, y in ((a, b), (b, a)):
            out = out.unionByName(of(x).exceptAll(of(y)).select(F.lit(x).alias("one"), F.lit(y).alias("other"), "kind", "item"))
    return out
