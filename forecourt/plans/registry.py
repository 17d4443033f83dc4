"""Query registry: each named query is a Spark function of (spark, data_dir) plus, where the
semantics are plain SQL, the same query as SQL text for an independent engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = " ".join(sql.split())
        return fn
    return deco


def load_all() -> None:
    """Import the modules whose decorators fill the registry."""
    from forecourt.plans import basics, deals, margin, refurb_testdata  # noqa: F401
