"""Nested records as related flat tables, with interval labels.

A depth-first traversal numbers the objects of a JSON text: ``pre`` when an object is
entered, ``post`` when it is left, both from one counter. Node b lies inside node a of the
same part exactly if ``a.pre < b.pre AND b.post < a.post``, so any two node tables can be
linked by an equality on (record, part) with a range as the residual.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NODE_SCHEMA = "rid string, part string, node_key string, parent_key string, type string, pre int, post int, parent_pre int, depth int, text string, attrs map<string,string>"
_TOKEN = re.compile(r'[ \t\n\r]*(?:([\[\]{}:,])|("(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*")|(-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null))')


def parse_deep(text: str) -> object:
    """JSON of any depth without recursion, for what the standard parser finds too deep. ValueError if it isn't JSON."""
    root: list = []
    stack: list[tuple[object, str | None]] = [(root, None)]
    pos, want = 0, "value"
    while True:
        m = _TOKEN.match(text, pos)
        if not m:
            if text[pos:].strip(" \t\n\r") == "" and len(stack) == 1 and root:
                return root[0]
            raise ValueError("not JSON")
        pos = m.end()
        sign, string, atom = m.groups()
        box, key = stack[-1]
        if len(stack) == 1 and root:
            raise ValueError("text after the value")
        if sign in ("]", "}"):
            if len(stack) == 1 or (sign == "]") != isinstance(box, list) or want not in ("next", "first"):
                raise ValueError("not JSON")
            stack.pop()
            want = "next"
            continue
        if want == "next":
            if sign != ",":
                raise ValueError("not JSON")
            want = "value" if isinstance(box, list) else "key"
            continue
        if isinstance(box, dict) and want in ("key", "first"):
            if string is None:
                raise ValueError("not JSON")
            stack[-1] = (box, json.loads(string, strict=True))
            want = "colon"
            continue
        if want == "colon":
            if sign != ":":
                raise ValueError("not JSON")
            want = "value"
            continue
        value: object
        if sign == "[":
            value = []
        elif sign == "{":
            value = {}
        elif sign is None:
            value = json.loads(string if string is not None else atom, parse_int=_whole)
        else:
            raise ValueError("not JSON")
        if isinstance(box, list):
            box.append(value)
        else:
            box[key] = value  # type: ignore[index]
        if sign:
            stack.append((value, None))
            want = "first"
        else:
            want = "next"


def _strict(name: str) -> object:
    raise ValueError(f"{name} isn't JSON")


def _whole(digits: str) -> object:
    """A whole number; one too long to be read as a number stays text."""
    return int(digits) if len(digits) <= 4000 else digits


def load(text: str) -> object:
    """The value of a JSON text of any depth. ValueError if it isn't JSON."""
    try:
        return json.loads(text, parse_constant=_strict, parse_int=_whole)
    except RecursionError:
        return parse_deep(text)


def sound(text: str) -> str:
    """Without lone surrogates, which no column can hold; they become question marks."""
    return text.encode("utf-8", "replace").decode()


def label(part: str, root: object) -> Iterator[tuple]:
    """Node tuples of one value: key, parent's key, type, pre, post, parent's pre, depth, text, attributes.

    An element is an object with a non-null ``type``. Objects without one open no element:
    what they hold belongs to the nearest element around them. Explicit stack, so depth is no
    limit. The traversal gives each element its interval; parents come from the intervals.
    """
    counter = 0
    out: list[list] = []
    stack: list[tuple[object, str, int]] = [(root, part, -1)]
    while stack:
        value, key, leaving = stack.pop()
        if leaving >= 0:
            out[leaving][4] = counter
            counter += 1
            continue
        if isinstance(value, dict):
            kind = value.get("type")
            if kind is not None:
                text = value.get("text")
                attrs = [(k, v if isinstance(v, str) else json.dumps(v)) for k, v in value.items() if k not in ("type", "text") and v is not None and not isinstance(v, (dict, list))]
                stack.append((None, key, len(out)))
                out.append([key, "", kind if isinstance(kind, str) else json.dumps(kind), counter, None, None, 0, text if isinstance(text, str) else None, attrs])
                counter += 1
            for k, v in reversed(value.items()):
                if isinstance(v, (dict, list)):
                    stack.append((v, f"{key}.{k}", -1))
        elif isinstance(value, list):
            for i in range(len(value) - 1, -1, -1):
                if isinstance(value[i], (dict, list)):
                    stack.append((value[i], f"{key}.{i}", -1))
    link(out)
    yield from map(tuple, out)


def link(nodes: list[list]) -> None:
    """Set parent's key, parent's pre and depth of nodes in order of pre: the parent is the last opened interval that still contains the node's."""
    around: list[list] = []
    for node in nodes:
        while around and around[-1][4] < node[3]:
            around.pop()
        if around:
            node[1], node[5], node[6] = around[-1][0], around[-1][3], len(around)
        around.append(node)


def json_nodes(df: DataFrame, rid: Column, parts: list[str]) -> DataFrame:
    """The node table of the JSON columns ``parts``.

    Null columns, empty texts and texts that aren't valid JSON give no rows; lone surrogates become question marks; a valid text
    without any typed object gives none either. Two rows of one id give their nodes twice.
    """
    schema = pa.schema([("rid", pa.string()), ("part", pa.string()), ("node_key", pa.string()), ("parent_key", pa.string()), ("type", pa.string()), ("pre", pa.int32()), ("post", pa.int32()), ("parent_pre", pa.int32()), ("depth", pa.int32()), ("text", pa.string()), ("attrs", pa.map_(pa.string(), pa.string()))])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        try:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        except UnicodeEncodeError:
            clean = lambda v: sound(v) if isinstance(v, str) else [(sound(k), sound(x)) for k, x in v] if isinstance(v, list) else v
            return batch([tuple(map(clean, r)) for r in rows])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_pylist()
            rows: list[tuple] = []
            size = 0  # signs of keys, which are long in deep texts
            for n, part in enumerate(parts):
                for i, text in zip(ids, b.column(n + 1).to_pylist()):
                    if text is None:
                        continue
                    try:
                        root = load(text)
                    except ValueError:
                        continue
                    for node in label(part, root):
                        rows.append((i, part, *node))
                        size += len(node[0]) + len(node[1])
                        if len(rows) >= 20_000 or size > 1 << 25:
                            yield batch(rows)
                            rows, size = [], 0
            if rows:
                yield batch(rows)

    return df.select(rid.cast("string").alias("rid"), *[F.col(p).cast("string").alias(f"p{i}") for i, p in enumerate(parts)]).mapInArrow(run, NODE_SCHEMA)


def tables_by_type(nodes: DataFrame, types: list[str]) -> dict[str, DataFrame]:
    """One flat table per element type, all with the interval labels."""
    return {t: nodes.where(F.col("type") == t) for t in types}


def inside(outer: DataFrame, inner: DataFrame, keys: tuple[str, ...] = ("rid", "part")) -> DataFrame:
    """Pairs (outer, inner) where the inner node lies inside the outer one, by interval containment."""
    a = outer.select(*keys, F.col("node_key").alias("outer_key"), F.col("pre").alias("_a"), F.col("post").alias("_z"))
    b = inner.select(*keys, F.col("node_key").alias("inner_key"), F.col("pre").alias("_b"), F.col("post").alias("_y"))
    return a.join(b, list(keys)).where((F.col("_a") < F.col("_b")) & (F.col("_y") < F.col("_z"))).select(*keys, "outer_key", "inner_key")


def array_nodes(df: DataFrame, doc: str, own: str, items: str, idx: str) -> DataFrame:
    """Rows (doc_id, node_key, parent_key, pre, post) of records with one array of objects, without any shuffle.

    The record is entered at 0 and left at 2n+1, its k-th item spans (2k+1, 2k+2). A null or
    empty array gives the record alone; null items are skipped; a record without a key gives nothing.
    """
    n = F.coalesce(F.size(F.filter(items, lambda x: x.isNotNull())), F.lit(0))
    n = F.when(n < 0, 0).otherwise(n)
    base = df.where(F.col(own).isNotNull()).select(F.col(doc).alias("doc_id"), F.col(own).alias("_own"), F.filter(items, lambda x: x.isNotNull()).alias("_items"), n.alias("_n"))
    record = F.struct(F.col("_own").alias("node_key"), F.lit("").alias("parent_key"), F.lit(0).alias("pre"), (2 * F.col("_n") + 1).cast("int").alias("post"))
    children = F.transform(
        F.coalesce("_items", F.expr("filter(_items, x -> false)")),
        lambda x, i: F.struct(F.concat("_own", F.lit("."), F.coalesce(x[idx], i).cast("string")).alias("node_key"), F.col("_own").alias("parent_key"), (2 * i + 1).cast("int").alias("pre"), (2 * i + 2).cast("int").alias("post")),
    )
    return base.select("doc_id", F.explode(F.concat(F.array(record), F.coalesce(children, F.array().cast("array<struct<node_key:string,parent_key:string,pre:int,post:int>>")))).alias("r")).select("doc_id", "r.*")
