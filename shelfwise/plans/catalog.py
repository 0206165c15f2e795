"""name -> query, and name -> the same in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.plans import index_queries, ingest_queries, snapshot_queries, text_queries

MODULES = (snapshot_queries, text_queries, index_queries, ingest_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for m in MODULES for name, query in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
