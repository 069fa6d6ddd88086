"""Collects the queries of the core modules."""

from __future__ import annotations

from importlib import import_module

MODULES = ("scores", "scalars", "similar", "datasets", "logs", "checks", "files", "pipeline")


def queries() -> dict:
    out: dict = {}
    for name in MODULES:
        out |= import_module(f"gaugeworks.plans.{name}").QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for name in MODULES:
        out |= import_module(f"gaugeworks.plans.{name}").ORACLE
    return out
