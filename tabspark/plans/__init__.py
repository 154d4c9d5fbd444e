"""Registered queries over the given tables, each with its SQL check where SQL can say it."""

from __future__ import annotations

from importlib import import_module

FAMILIES = ("basics", "profiles", "diagnostics", "shaping", "fitting", "scoring", "results",
            "closed_forms", "searches")


def load() -> tuple[dict, dict]:
    """({name: callable}, {name: sql}) of every family."""
    from tabspark.plans.registry import ORACLE, QUERIES

    for f in FAMILIES:
        import_module(f"tabspark.plans.{f}")
    return QUERIES, ORACLE
