"""SLA checks (operators V1-V4, S7).

Freshness and completeness need two numbers of Bronze — the latest
``updated_at`` and the rows ingested on the check's UTC day.  Both were observed
on the write of each batch and stand in the batch log, so the checks fold that
log (:func:`of_batches`) and read no Bronze file; :func:`metrics` takes them
from the rows themselves in one aggregate pass.  The schema check is metadata only.  Each rule
of the configuration yields one result row carrying its
``business_impact``; unknown rule names are reported and skipped; a failing
check is a FAIL row, never an exception.  ``as_of`` replaces the wall clock.
"""

from __future__ import annotations

import datetime as dt
import logging
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeguard.functions.text import list_text, type_changes_text
from lakeguard.operators import drift
from lakeguard.session import local_table

log = logging.getLogger(__name__)

RULES_PATH = str(Path(__file__).resolve().parents[1] / "contracts" / "sla_config.json")
KNOWN_CHECKS = ("freshness", "completeness", "schema_consistency")
RESULT_SCHEMA = "check_name string, status string, detail string, business_impact string"


def load_rules(spark: SparkSession, path: str = RULES_PATH) -> DataFrame:
    """The rules file as a DataFrame, one row per rule."""
    raw = spark.read.option("multiLine", True).json(path)
    return raw.select(F.explode("sla_checks").alias("r")).select("r.*")


def ts_literal(as_of: dt.datetime | str) -> Column:
    text = as_of.isoformat(sep=" ") if isinstance(as_of, dt.datetime) else as_of
    return F.lit(text).cast("timestamp_ntz")


def ingest_day(bronze: DataFrame) -> Column:
    """The UTC day a Bronze row was ingested.  On the lake table this is the
    ``_ingest_date`` partition column (``to_date(_ingested_at)`` by
    construction), which is constant per file: counting on it reads no data
    column, so the SLA pass scans ``updated_at`` only."""
    return F.col("_ingest_date") if "_ingest_date" in bronze.columns else F.to_date("_ingested_at")


def of_batches(batch_log: DataFrame) -> DataFrame:
    """One row per batch in Bronze: what its last write was observed to hold.

    A batch written again replaces what it wrote before, so only its newest log row counts.
    """
    columns = ["ingested_at", "rows", "latest_updated_at"]
    newest = F.max_by(F.struct(*columns), F.struct("logged_at", "source_id"))
    return batch_log.groupBy("batch_id").agg(newest.alias("r")).select("batch_id", *[f"r.{c}" for c in columns])


def metrics(source: DataFrame, as_of: Column | list[Column]) -> DataFrame:
    """Latest updated_at and the rows ingested on as_of's day (``rows_today``, or ``rows_today_<i>`` for a
    list), from Bronze rows in one pass or from :func:`of_batches`."""
    if "latest_updated_at" in source.columns:
        newest, day, rows = "latest_updated_at", F.to_date("ingested_at"), F.col("rows")
    else:
        newest, day, rows = "updated_at", ingest_day(source), F.lit(1)
    days = {f"rows_today_{i}": at for i, at in enumerate(as_of)} if isinstance(as_of, list) else {"rows_today": as_of}
    return source.agg(F.max(newest).alias("latest_updated_at"), *[
        F.coalesce(F.sum(F.when(day == F.to_date(at), rows)), F.lit(0)).cast("long").alias(name) for name, at in days.items()])


def age_hours(latest: Column, as_of: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", latest, as_of) / F.lit(3.6e9)


def freshness_result(as_of: Column, threshold_hours) -> Column:
    """V1 over the metrics row: FAIL if no rows or age strictly above the
    threshold (exactly at it passes)."""
    latest = F.col("latest_updated_at")
    age = age_hours(latest, as_of)
    over = age > F.lit(float(threshold_hours))
    status = F.when(latest.isNull() | over, "FAIL").otherwise("PASS")
    detail = (F.when(latest.isNull(), F.lit("No data in Bronze table"))
              .when(over, F.format_string(f"Data is %.1fh old, threshold={threshold_hours}h",
                                          F.bround(age, 1)))
              .when(age < 0, F.format_string("Latest updated_at is %.1fh in the future",
                                             F.bround(-age, 1)))
              .otherwise(F.lit("")))
    return F.struct(F.lit("freshness").alias("check_name"), status.alias("status"),
                    detail.alias("detail"))


def completeness_result(min_rows, rows_col: str = "rows_today") -> Column:
    """V2 over the metrics row: FAIL if fewer than ``min_rows`` rows were
    ingested on the day (exactly ``min_rows`` passes)."""
    fail = F.col(rows_col) < F.lit(int(min_rows))
    return F.struct(F.lit("completeness").alias("check_name"),
                    F.when(fail, "FAIL").otherwise("PASS").alias("status"),
                    F.when(fail, F.format_string(f"Row count %d below minimum {int(min_rows)}",
                                                 F.col(rows_col)))
                    .otherwise(F.lit("")).alias("detail"))


def _results(m: DataFrame, results: list[Column], extra: list[Column] = ()) -> DataFrame:
    """All metric-based results from the one metrics row (one scan)."""
    return m.select(*extra, F.inline(F.array(*results)))


def freshness(m: DataFrame, as_of: Column, threshold_hours) -> DataFrame:
    return _results(m, [freshness_result(as_of, threshold_hours)])


def completeness(m: DataFrame, min_rows) -> DataFrame:
    return _results(m, [completeness_result(min_rows)])


def schema_consistency(live_contract: DataFrame, pinned: DataFrame,
                       spark: SparkSession) -> DataFrame:
    """V3: FAIL iff the live contract is BREAKING against the pinned one."""
    pairs = local_table(spark, [("live", "pinned")], "batch_id string, baseline_key string")
    v = drift.classify(live_contract.withColumn("contract_key", F.lit("live")),
                       pinned.withColumn("contract_key", F.lit("pinned")), pairs)
    breaking = F.col("verdict") == drift.BREAKING
    detail = F.concat(F.lit("removed="), list_text("removed"),
                      F.lit(" type_changes="), type_changes_text("type_changes"))
    return v.select(F.lit("schema_consistency").alias("check_name"),
                    F.when(breaking, "FAIL").otherwise("PASS").alias("status"),
                    F.when(breaking, detail).otherwise(F.lit("")).alias("detail"))


def run_checks(spark: SparkSession, source: DataFrame, as_of,
               live_contract: DataFrame | None = None, pinned: DataFrame | None = None,
               rules: list[dict] | None = None) -> DataFrame:
    """V4: every configured rule -> (check_name, status, detail, business_impact, checked_at).

    ``as_of`` is one instant or a list of them (several runs evaluated
    together); freshness and completeness for all of them come from one
    aggregate over ``source``, Bronze or its batches (:func:`of_batches`)."""
    if rules is None:
        rules = [r.asDict() for r in load_rules(spark).collect()]  # config-sized
    instants = [ts_literal(a) for a in (as_of if isinstance(as_of, (list, tuple)) else [as_of])]
    metric_results, parts = [], []
    for rule in rules:
        name = rule["check_name"]
        impact = F.lit(rule["business_impact"])
        if name not in KNOWN_CHECKS:
            log.warning("Unknown SLA check: %s", name)
            continue
        if name == "schema_consistency":
            if live_contract is None or pinned is None:
                raise ValueError("schema_consistency needs the live and pinned contracts")
            # instant-independent: evaluated once, reported for every instant
            parts.append(schema_consistency(live_contract, pinned, spark).withColumns({
                "business_impact": impact, "checked_at": F.explode(F.array(*instants))}))
            continue
        for i, at in enumerate(instants):
            result = (freshness_result(at, rule["threshold_hours"]) if name == "freshness"
                      else completeness_result(rule["min_rows_per_run"], f"rows_today_{i}"))
            metric_results.append(F.struct(result.alias("r"), impact.alias("business_impact"),
                                           at.alias("checked_at")))
    if metric_results:
        rows = metrics(source, instants).select(F.inline(F.array(*metric_results)))
        parts.insert(0, rows.select("r.*", "business_impact", "checked_at"))
    if not parts:
        return local_table(spark, [], RESULT_SCHEMA).withColumn("checked_at", instants[0])
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
