"""Registered queries: one per operator of the inventory, each with its
ANSI-SQL equivalent for the DuckDB oracle.

Every query reads the provided tables (or DataFrames Spark derives from
them) in full; nothing is sampled or capped.  Column names are aliased the
same way on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: register ``fn(spark, sf_dir)`` under ``name`` with its oracle."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from lakeguard.plans import catalog  # noqa: F401
