"""Registered queries over the test tables, each with the SQL that must give the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MODULES = ["tables", "texts", "style", "lexicon", "vectors", "matrix", "learn", "judge", "jobs"]


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def load_all() -> None:
    for module in MODULES:
        import_module(f"lexiframe.queries.{module}")
