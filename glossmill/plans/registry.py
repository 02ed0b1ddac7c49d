"""All queries of the core and their SQL, by name."""

from __future__ import annotations

from importlib import import_module

MODULES = ("packed", "corpus", "sequences", "evaluation", "control")


def collect() -> tuple[dict, dict]:
    queries: dict = {}
    oracles: dict = {}
    for name in MODULES:
        m = import_module(f"glossmill.plans.{name}")
        queries |= m.QUERIES
        oracles |= m.ORACLES
    return queries, oracles
