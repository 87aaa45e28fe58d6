"""The queries of the subpackage and their SQL, by name."""

from __future__ import annotations

import importlib

MODULES = ("nearjoin", "sharding", "packing", "vectors", "toxicity", "linededup", "media", "lm", "substrings", "mixing", "alignment", "bestfit", "divergence")


def _all(what: str) -> dict:
    return {k: v for m in MODULES for k, v in getattr(importlib.import_module(f"{__package__}.{m}"), what).items()}


def queries() -> dict:
    return _all("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _all("ORACLES")
