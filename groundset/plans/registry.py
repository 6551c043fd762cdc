"""All registered queries of the core and their SQL, by name."""

from __future__ import annotations

import importlib

#: Modules with QUERIES (name -> callable(spark, sf_dir)) and ORACLE (name -> SQL).
MODULES = ("groundset.plans.tasks", "groundset.plans.records", "groundset.plans.markup", "groundset.plans.nested", "groundset.plans.rules", "groundset.plans.build")


def queries() -> dict:
    out: dict = {}
    for name in MODULES:
        out |= importlib.import_module(name).QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for name in MODULES:
        out |= getattr(importlib.import_module(name), "ORACLE", {})
    return out
