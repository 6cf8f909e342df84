"""The query catalogue: name -> query over a folder of tables, and its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that gives the same rows when there is one."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE_SQL[name] = sql
        return function

    return register


def load() -> None:
    """Import every module that registers queries."""
    from evidmap.plans import (  # noqa: F401
        queries_clusters,
        queries_evidence,
        queries_extract,
        queries_graph,
        queries_ingest,
        queries_records,
        queries_reports,
    )
