"""Registry of runnable queries and their DuckDB oracle SQL.

A *query* binds one or more library operators to the fixture tables (the
stand-ins of FIXTURES.md part 3) and returns a DataFrame. Its oracle is an
independent SQL statement over the same tables; the two must agree on
column names, row count and values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``sql`` is the oracle; leave it out only for results that SQL cannot
    state (physical partition ids, random generators, stateful folds).
    """

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


PLAN_MODULES = (
    "q_retail", "q_windows", "q_sessions", "q_scalars", "q_etl", "q_scd", "q_match",
    "q_quality", "q_sources", "q_sinks", "q_stream",
)


def load_all() -> None:
    """Import every plan module so that its queries register themselves."""
    import importlib
    import importlib.util

    for m in PLAN_MODULES:
        name = f"kestrel.plans.{m}"
        if importlib.util.find_spec(name) is not None:
            importlib.import_module(name)
