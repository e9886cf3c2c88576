"""Registered queries of this subpackage and the SQL some of them are compared against."""

from __future__ import annotations

import importlib

QUERIES: dict = {}
SQL: dict[str, str] = {}
MODULES = ("queries_text", "queries_corpus")


def query(name: str, sql: str | None = None):
    """Registers the decorated (spark, sf_dir) callable under ``name``."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def documents(spark, sf_dir: str):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def load() -> tuple[dict, dict]:
    for name in MODULES:
        importlib.import_module(f"riskweave.llm.{name}")
    return QUERIES, SQL
