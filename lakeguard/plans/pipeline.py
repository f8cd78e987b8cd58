"""One pipeline run (operators I2, M3, V4 write-out, C1 for model runs).

Stages run in dependency order — ingest, Silver, Gold, SLA checks — and a
halted ingest (BREAKING contract change) skips every later stage, like a job
whose first task failed.  The driver only sequences stages; each stage is
Spark work.  Returns one status row per stage.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeguard.operators import cost, quality, sla
from lakeguard.plans import ingest as ig
from lakeguard.plans import key_counts, models
from lakeguard.plans import lake as lk
from lakeguard.session import local_table
from lakeguard.sources import contracts as ct

MODELS_PIPELINE = "orders_models"
STAGES = ("ingest_bronze", "silver", "gold", "sla_check")
STATUS_SCHEMA = "stage string, status string, detail string, seconds double"


def run_sla(spark: SparkSession, lake: lk.Lake, as_of: dt.datetime | None = None,
            pinned_version: str = "v1") -> DataFrame:
    """V4 on the live table, appended to ``sla_check_log`` (pass or fail).

    The numbers come from the batch log and the contract from the recorded schema: no Bronze file is read.
    """
    as_of = as_of or ig.utc_now()
    live = ct.contract_of(spark, {"live": ct.live_schema(spark, lake.bronze)})
    results = sla.run_checks(spark, sla.of_batches(lk.read_log(spark, lake, "batch_log")), as_of, live_contract=live,
                             pinned=ct.seed_contracts(spark, [pinned_version]))
    lk.append_log(spark, lake, "sla_check_log", results)
    return lk.read_log(spark, lake, "sla_check_log").filter(
        F.col("checked_at") == sla.ts_literal(as_of))


def run_data_tests(spark: SparkSession, lake: lk.Lake) -> DataFrame:
    """Q3 on the live tables: every declared test, reported (never raised).

    Bronze's are kept up by batch and read the batches that arrived since the last call only.
    """
    key_counts.update(spark, lake)
    tables = []
    if lk.exists(spark, lake.silver):
        tables.append(quality.declared("silver.orders_cleaned", spark.read.parquet(lake.silver)))
    if lk.exists(spark, lake.gold):
        tables.append(quality.declared("gold.daily_revenue", spark.read.parquet(lake.gold)))
    bronze = key_counts.report(spark, lake)
    return bronze.unionByName(quality.report(tables)) if tables else bronze


def run(spark: SparkSession, lake: lk.Lake, batch: DataFrame, *, batch_id: str,
        schema_version: str = "v1", silver_mode: str = "arrival",
        gold_mode: str = "touched_dates", full_refresh: bool = False,
        ingested_at: dt.datetime | None = None, as_of: dt.datetime | None = None,
        dbu_per_hour: float = cost.DBU_PER_HOUR, rate: float = cost.DBU_RATE_USD) -> DataFrame:
    """Ingest -> Silver -> Gold -> SLA.

    The stage that fails, for whatever reason, is reported with its error, and
    the later ones as skipped; a run started again takes up what is left.
    """
    rows = []
    seconds: dict[str, float] = {}
    made: dict = {}

    def models_cost() -> None:
        # the model run's cost row, with its real run type (full or incremental)
        s = made["silver"]
        ig.log_cost(spark, lake, seconds["silver"] + seconds["gold"], int(s.get("rows") or 0),
                    "full_refresh" if s["mode"] == "full_refresh" else "incremental",
                    MODELS_PIPELINE, dbu_per_hour=dbu_per_hour, rate=rate)

    def gold():
        return models.gold_full_refresh(spark, lake) if full_refresh else models.gold_incremental(spark, lake, mode=gold_mode)

    def silver():
        return models.silver_full_refresh(spark, lake) if full_refresh else models.silver_incremental(spark, lake, mode=silver_mode)

    steps = {
        "ingest_bronze": lambda: ig.ingest(spark, batch, lake, batch_id=batch_id, schema_version=schema_version,
                                           ingested_at=ingested_at, evaluated_at=as_of, dbu_per_hour=dbu_per_hour, rate=rate),
        "silver": silver, "gold": gold,
        "sla_check": lambda: models_cost() or run_sla(spark, lake, as_of).count()}
    for name in STAGES:
        t0 = time.perf_counter()
        try:
            out = made[name] = steps[name]()
        except Exception as e:
            rows.append((name, "FAILED", f"{type(e).__name__}: {e}", round(time.perf_counter() - t0, 3)))
            rows += [(s, "SKIPPED", "upstream failed", 0.0) for s in STAGES[STAGES.index(name) + 1:]]
            break
        seconds[name] = round(time.perf_counter() - t0, 3)
        rows.append((name, "SUCCESS", str(out.get("rows", out) if isinstance(out, dict) else out), seconds[name]))
    return local_table(spark, rows, STATUS_SCHEMA)
