"""Queries over the given tables, one or more for each operator, with the SQL that gives the same rows."""

from __future__ import annotations

import importlib

MODULES = ("observations", "grids", "cycles", "registries", "manifests", "chains", "stores")


def _all(what: str) -> dict:
    return {k: v for m in MODULES for k, v in getattr(importlib.import_module(f"{__package__}.{m}"), what).items()}


def queries() -> dict:
    return _all("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _all("ORACLES")
