"""Contract drift: column changes and verdicts (operators N2, N3, N4, N7, J3, U1).

Rules (names compared exactly, case-sensitive; types after F1 normalisation):

* a column in the batch but not in the baseline is ADDED   -> non-breaking
* a column in the baseline but not in the batch is REMOVED -> breaking
* a column in both with different canonical types is TYPE_CHANGED -> breaking

A rename is one REMOVED plus one ADDED.  Column order never matters.  An
identical schema is NON_BREAKING.

Inputs are contract DataFrames, so any number of batches (or files) is
checked against any number of baselines in one job: ``batches`` maps each
``batch_id`` to the ``contract_key`` of its baseline.  The only joins are
equi-joins on (batch, column); no batch is paired with another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeguard.functions.text import list_text, type_changes_text

# The tables a breaking change halts, in the order reported.
DOWNSTREAM = ["bronze.raw_orders", "silver.orders_cleaned", "gold.daily_revenue"]

ADDED, REMOVED, TYPE_CHANGED, SAME = "ADDED", "REMOVED", "TYPE_CHANGED", "SAME"
BREAKING, NON_BREAKING = "BREAKING", "NON_BREAKING"


def column_changes(incoming: DataFrame, baseline: DataFrame, batches: DataFrame) -> DataFrame:
    """Column-level drift rows.

    incoming: contract rows keyed by ``contract_key`` = batch id
    baseline: contract rows keyed by ``contract_key`` = baseline key
    batches:  ``(batch_id, baseline_key)``
    """
    inc = incoming.select(
        F.col("contract_key").alias("batch_id"), "column_name",
        F.col("ordinal").alias("actual_ordinal"), F.col("type").alias("actual_type"))
    exp = batches.join(
        baseline.withColumnRenamed("contract_key", "baseline_key"), "baseline_key"
    ).select("batch_id", "column_name", F.col("ordinal").alias("expected_ordinal"),
             F.col("type").alias("expected_type"))
    j = inc.join(exp, ["batch_id", "column_name"], "full_outer")
    change = (F.when(F.col("expected_type").isNull(), F.lit(ADDED))
              .when(F.col("actual_type").isNull(), F.lit(REMOVED))
              .when(F.col("actual_type") != F.col("expected_type"), F.lit(TYPE_CHANGED))
              .otherwise(F.lit(SAME)))
    return j.select("batch_id", "column_name", change.alias("change"),
                    "expected_type", "actual_type", "expected_ordinal", "actual_ordinal")


def _names(kind: str, ordinal: str) -> Column:
    pairs = F.filter(F.collect_list(F.struct(F.col(ordinal).alias("o"), F.col("column_name").alias("n"),
                                             F.col("change").alias("k"))),
                     lambda s: s["k"] == kind)
    return F.transform(F.array_sort(pairs), lambda s: s["n"])


def verdicts(changes: DataFrame, downstream: Sequence[str] = DOWNSTREAM) -> DataFrame:
    """One verdict row per batch (N3): lists in the order the rules report them
    (added and type changes in batch order, removed in baseline order)."""
    tc = F.filter(F.collect_list(F.struct(
        F.col("actual_ordinal").alias("o"), F.col("column_name"),
        F.col("expected_type").alias("expected"), F.col("actual_type").alias("actual"),
        F.col("change").alias("k"))), lambda s: s["k"] == TYPE_CHANGED)
    g = changes.groupBy("batch_id").agg(
        _names(ADDED, "actual_ordinal").alias("added"),
        _names(REMOVED, "expected_ordinal").alias("removed"),
        F.transform(F.array_sort(tc), lambda s: F.struct(
            s["column_name"].alias("column"), s["expected"].alias("expected"),
            s["actual"].alias("actual"))).alias("type_changes"),
        F.bool_or(F.col("change").isin(REMOVED, TYPE_CHANGED)).alias("breaking"))
    affected = F.when(F.col("breaking"), F.array(*[F.lit(x) for x in downstream])) \
        .otherwise(F.array().cast("array<string>"))
    return g.select(
        "batch_id",
        F.when(F.col("breaking"), F.lit(BREAKING)).otherwise(F.lit(NON_BREAKING)).alias("verdict"),
        "added", "removed", "type_changes", affected.alias("affected_pipelines"))


def verdict_text(v: DataFrame) -> DataFrame:
    """Verdict rows with the list columns in their text form (log format)."""
    return v.select("batch_id", "verdict",
                    list_text("added").alias("added_columns"),
                    list_text("removed").alias("removed_columns"),
                    type_changes_text("type_changes").alias("type_changes"),
                    list_text("affected_pipelines").alias("affected_pipelines"))


def classify(incoming: DataFrame, baseline: DataFrame, batches: DataFrame,
             downstream: Sequence[str] = DOWNSTREAM) -> DataFrame:
    return verdicts(column_changes(incoming, baseline, batches), downstream)
