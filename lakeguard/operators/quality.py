"""Declared data tests (operators Q1-Q3).

A table's whole suite is one pass: rows are grouped by the unique key (partial
counts per task, one shuffle, so a hot key costs one row per task), each group
carries its row count and the null counts of every declared column, and one
more aggregate folds the groups to all tests.  A table without a unique test
needs no grouping.  Failing tests are reported, never raised.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The declared tests of the three layers (table -> columns).
DECLARED = {
    "bronze.raw_orders": {
        "not_null": ["order_id", "customer_id", "product_id", "quantity", "unit_price", "status",
                     "created_at", "updated_at", "_ingested_at", "_schema_version", "_source"],
        "unique": ["order_id"],
    },
    "silver.orders_cleaned": {
        "not_null": ["order_id", "customer_id", "product_id", "quantity", "unit_price",
                     "line_total", "status", "created_at", "updated_at", "_ingested_at",
                     "_schema_version", "_source"],
        "unique": ["order_id"],
    },
    "gold.daily_revenue": {
        "not_null": ["order_date", "total_orders", "gross_revenue", "avg_order_value"],
        "unique": ["order_date"],
    },
}

RESULT_COLUMNS = ["table_name", "column_name", "test", "failures", "status"]


@dataclass
class TableTests:
    table_name: str
    df: DataFrame
    not_null: Sequence[str] = field(default_factory=list)
    unique: Sequence[str] = field(default_factory=list)


def not_null(df: DataFrame, columns: Sequence[str], table_name: str) -> DataFrame:
    """Q1: null count of every column in one pass, one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = counts.unpivot([], list(columns), "column_name", "failures")
    return rows.select(F.lit(table_name).alias("table_name"), "column_name",
                       F.lit("not_null").alias("test"), "failures")


def unique(df: DataFrame, column: str, table_name: str) -> DataFrame:
    """Q2: number of non-null key values that occur more than once."""
    dup = (df.filter(F.col(column).isNotNull()).groupBy(column)
           .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))
    return dup.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(table_name).alias("table_name"), F.lit(column).alias("column_name"),
        F.lit("unique").alias("test"), "failures")


def suite(t: TableTests) -> DataFrame:
    """All tests of a table from one scan and one shuffle (further unique columns: one of each more)."""
    if not t.unique:
        return not_null(t.df, t.not_null, t.table_name)
    key, *others = t.unique
    nulls = {f"__null_{i}": c for i, c in enumerate(t.not_null)}
    keyed = t.df.groupBy(F.col(key).alias("__key")).agg(
        F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(a) for a, c in nulls.items()])
    folded = keyed.agg(F.count_if(F.col("__key").isNotNull() & (F.col("__n") > 1)).alias("__dup"),
                       *[F.coalesce(F.sum(a), F.lit(0)).cast("long").alias(a) for a in nulls])
    tests = [F.struct(F.lit(c).alias("column_name"), F.lit("not_null").alias("test"), F.col(a).alias("failures"))
             for a, c in nulls.items()]
    tests.append(F.struct(F.lit(key).alias("column_name"), F.lit("unique").alias("test"), F.col("__dup").alias("failures")))
    out = folded.select(F.lit(t.table_name).alias("table_name"), F.inline(F.array(*tests)))
    for c in others:
        out = out.unionByName(unique(t.df, c, t.table_name))
    return out


def report(tables: Sequence[TableTests]) -> DataFrame:
    """Q3: one PASS/FAIL row per (table, column, test)."""
    parts = [suite(t) for t in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("failures") == 0, "PASS").otherwise("FAIL"))


def declared(table_name: str, df: DataFrame) -> TableTests:
    spec = DECLARED[table_name]
    return TableTests(table_name, df, spec["not_null"], spec["unique"])
