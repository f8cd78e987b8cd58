"""The contract gate over many landed batches at once (operators N2-N5, N8, S6, V3).

A batch is a folder of Parquet files below a landing root.  Every footer is read
once, each distinct schema compared once with the baseline, and the verdicts of
its files make the batch's: one breaking file breaks it.  ``route_batches``
writes all verdicts to the logs in two appends; the caller halts what broke.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeguard.operators import drift
from lakeguard.plans import lake as lk
from lakeguard.sources import contracts as ct
from lakeguard.sources import files as fl


def batch_footers(spark: SparkSession, root: str) -> DataFrame:
    """(path, file_name, fingerprint, columns, batch_id) of every file below ``root``; the folder names the batch."""
    read = fl.footers(fl.list_files(spark, root))
    return read.withColumn("batch_id", F.element_at(F.split("path", "/"), -2))


def schema_changes(footers: DataFrame, baseline: DataFrame, versions: Column | None = None) -> DataFrame:
    """Column changes of every distinct schema of every batch: ``drift.column_changes`` rows with the
    fingerprint; batch_id, fingerprint and baseline are one pair each, however many files share the schema.

    ``versions``: array of the baseline keys a batch is compared with (default: the only one of ``baseline``).
    """
    pairs = footers.select("batch_id", "fingerprint").distinct()
    keys = versions if versions is not None else F.array(F.lit("baseline"))
    if versions is None:
        baseline = baseline.withColumn("contract_key", F.lit("baseline"))
    pairs = pairs.withColumn("baseline_key", F.explode(keys)).withColumn("pair", F.concat_ws("|", "batch_id", "fingerprint", "baseline_key"))
    contracts = fl.distinct_contracts(footers).filter(~F.col("column_name").isin(*ct.SYSTEM_COLUMNS))
    incoming = pairs.join(contracts.withColumnRenamed("contract_key", "fingerprint"), "fingerprint").select(
        F.col("pair").alias("contract_key"), "ordinal", "column_name", "type")
    found = drift.column_changes(incoming, baseline, pairs.select(F.col("pair").alias("batch_id"), "baseline_key"))
    return found.withColumnRenamed("batch_id", "pair").join(pairs, "pair").drop("pair")


def batch_verdicts(changes: DataFrame) -> DataFrame:
    """One verdict row per batch and baseline: that of its worst schema (breaking first, then by fingerprint)."""
    key = F.struct("batch_id", "fingerprint", "baseline_key")
    per_schema = drift.verdict_text(drift.verdicts(changes.withColumn("batch_id", key)))
    worst = F.struct((F.col("verdict") != drift.BREAKING).alias("fine"), F.col("batch_id.fingerprint").alias("fp"))
    columns = [c for c in per_schema.columns if c != "batch_id"]
    return (per_schema.groupBy("batch_id.batch_id", "batch_id.baseline_key")
            .agg(F.min_by(F.struct(*columns), worst).alias("v")).select("batch_id", "baseline_key", "v.*"))


def route_batches(spark: SparkSession, lake: lk.Lake, verdicts: DataFrame, baseline: str, evaluated_at: Column) -> None:
    """N5 for many batches: accepted ones to ``schema_change_log``, breaking ones to ``incident_log``."""
    rows = verdicts.withColumns({"evaluated_at": evaluated_at, "baseline": F.lit(baseline),
                                 "arrived_at": F.lit(None).cast("timestamp_ntz")})
    lk.append_log(spark, lake, "schema_change_log", rows.filter(F.col("verdict") == drift.NON_BREAKING))
    lk.append_log(spark, lake, "incident_log", rows.filter(F.col("verdict") == drift.BREAKING)
                  .withColumn("event", F.lit("PIPELINE_HALTED")))
