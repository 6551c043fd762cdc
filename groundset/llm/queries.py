"""The registered queries of the subpackage and their SQL, by name."""

from __future__ import annotations

import importlib

MODULES = ("canon", "overlap", "answers", "pack", "split", "mix", "residue", "leak", "scan")


def _each(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        out |= getattr(importlib.import_module(f"groundset.llm.{name}"), attribute, {})
    return out


def queries() -> dict:
    return _each("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _each("ORACLE")
