"""Registered queries with the SQL each one is compared against."""

from __future__ import annotations

import importlib

MODULES = ("clean", "profile", "bins", "stability", "selection", "metrics", "recoding", "models", "given", "stages")


def load() -> tuple[dict, dict]:
    from checks.common import QUERIES, SQL

    for name in MODULES:
        importlib.import_module(f"checks.{name}")
    return QUERIES, SQL
