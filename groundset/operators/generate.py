"""Rows through a caller's model with retries, and rewards from a caller's functions."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame


def generate(prompts: DataFrame, key: str, prompt: str, call: Callable[[str], str | None], check: Callable[[str], str | None], retries: int = 1) -> DataFrame:
    """(key, output, attempts, error): ``call`` makes a text, ``check`` returns what is wrong with it or None.

    At most max(1, retries) attempts; an empty answer fails at once. Nothing is called unless a callable is given.
    """
    kind = dict(prompts.dtypes)[key]

    def one(p: str | None) -> tuple[str | None, int, str | None]:
        error = "no prompt"
        for n in range(1, max(1, retries) + 1):
            if p is None:
                return None, 0, error
            out = call(p)
            if not out:
                return None, n, "empty answer"
            error = check(out)
            if error is None:
                return out, n, None
        return None, max(1, retries), error

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            got = [one(p) for p in f[prompt]]
            yield pd.DataFrame({key: f[key], "output": [g[0] for g in got], "attempts": [g[1] for g in got], "error": [g[2] for g in got]})

    return prompts.select(key, prompt).mapInPandas(run, f"`{key}` {kind}, output string, attempts int, error string")


def document_problem(answer: str) -> str | None:
    """What is wrong with an answer that should be a document as JSON ({"head": .., "body": [..]}), or None: for ``check``."""
    from groundset.operators.markup import render_document
    from groundset.operators.nested import load
    from groundset.sources.xml import ROOTS, shred_text

    try:
        made = load(answer)
    except ValueError as e:
        return f"not JSON: {e}"
    if not isinstance(made, dict) or not isinstance(made.get("body"), list):
        return "no body"
    text = render_document(json.dumps(made.get("head")) if made.get("head") is not None else None, json.dumps(made["body"]))
    return "unknown elements" if text is None else shred_text(text, ROOTS)[1]


def rewards(df: DataFrame, key: str, completion: str, functions: Sequence[Callable[[pd.Series], pd.Series]]) -> DataFrame:
    """(key, reward_0, reward_1, ...): each function maps a series of answers to a series of numbers."""
    kind = dict(df.dtypes)[key]
    names = [f"reward_{i}" for i in range(len(functions))]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({key: f[key], **{n: fn(f[completion]).astype(float) for n, fn in zip(names, functions)}})

    return df.select(key, completion).mapInPandas(run, f"`{key}` {kind}, " + ", ".join(f"{n} double" for n in names))
