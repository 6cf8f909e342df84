"""Queries of this subpackage: name -> query over a folder of tables, and its SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
MODULES = (
    "fingerprints",
    "decontaminate",
    "simhash",
    "lines",
    "shards",
    "packing",
    "language",
    "personal",
    "quality",
    "substrings",
    "compression",
    "centroids",
    "debruijn",
)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE_SQL[name] = sql
        return function

    return register


def load() -> None:
    for name in MODULES:
        importlib.import_module(f"evidmap.llm.{name}")
