"""Guarded Bronze ingest (operators I1, N5, N6, K2, K8, P1, C1).

Order of effects, pinned by tests:

1. the batch's contract is compared with the live Bronze contract (or the v1
   seed on the first run) — nothing is written before the verdict;
2. the verdict is logged: NON_BREAKING to ``schema_change_log`` (also when
   nothing changed), BREAKING to ``incident_log`` with ``PIPELINE_HALTED``;
3. BREAKING raises :class:`SchemaBreakingChangeError` *after* the incident
   row is durable, and Bronze is untouched;
4. otherwise the batch gets one ``_ingested_at`` for all its rows plus
   ``_schema_version`` / ``_source``, is cast to the live physical types
   (ANSI cast: overflow fails loudly instead of wrapping; a float column that
   meets doubles becomes double) and written as the partition of its batch id;
   row count and latest ``updated_at`` are observed on the write itself;
5. the table's schema is recorded if it grew, the batch and what was observed
   of it logged in ``batch_log``, and one cost row is appended.

A batch id names a batch: a replay, after a crash or a repeated delivery, keeps
the arrival stamp that the first attempt logged with its verdict, and replaces
what that one wrote.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeguard.operators import cost, drift
from lakeguard.plans import lake as lk
from lakeguard.session import local_table
from lakeguard.sources import contracts as ct
from lakeguard.sources import files
from lakeguard.sources.fixture import PIPELINE_ID


class SchemaBreakingChangeError(Exception):
    """Raised when a batch removes a contract column or changes its type."""


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def gate(spark: SparkSession, batch: DataFrame, lake: lk.Lake, batch_id: str,
         seed_version: str = "v1") -> tuple[dict, str]:
    """Verdict of one batch against the live contract (N6 baseline rule): the
    Bronze table's recorded schema, or the seed contract on the first run."""
    live = ct.live_schema(spark, lake.bronze)
    if live is not None and ct.same_contract(batch.schema, live):
        return {"batch_id": batch_id, "verdict": drift.NON_BREAKING, "added_columns": "[]", "removed_columns": "[]",
                "type_changes": "[]", "affected_pipelines": "[]"}, f"live table: {lake.bronze}"
    baseline, source = ct.baseline_contract(spark, lake.bronze, "baseline", seed_version)
    incoming = ct.contract_of(spark, {batch_id: batch.schema})
    pair = local_table(spark, [(batch_id, "baseline")], "batch_id string, baseline_key string")
    return drift.verdict_text(drift.classify(incoming, baseline, pair)).first().asDict(), source


def route(spark: SparkSession, lake: lk.Lake, verdict: dict, baseline: str,
          evaluated_at: dt.datetime, arrived_at: dt.datetime | None = None) -> None:
    """Log the verdict; raise on BREAKING after the incident row is written."""
    base = (evaluated_at, verdict["batch_id"], verdict["verdict"], verdict["added_columns"],
            verdict["removed_columns"], verdict["type_changes"], verdict["affected_pipelines"],
            baseline, arrived_at)
    if verdict["verdict"] == drift.NON_BREAKING:
        lk.append_log(spark, lake, "schema_change_log", [base])
    elif verdict["verdict"] == drift.BREAKING:
        lk.append_log(spark, lake, "incident_log", [base + ("PIPELINE_HALTED",)])
        raise SchemaBreakingChangeError(
            f"batch {verdict['batch_id']} breaks its contract and was not ingested: "
            f"columns gone {verdict['removed_columns']}, types changed {verdict['type_changes']}, "
            f"downstream {verdict['affected_pipelines']}")
    else:
        raise ValueError(f"unexpected verdict {verdict['verdict']!r}")


def enrich(batch: DataFrame, ingested_at: dt.datetime, schema_version: str,
           source: str = PIPELINE_ID) -> DataFrame:
    """Audit columns, one value for the whole run."""
    ts = F.lit(ingested_at.isoformat(sep=" ")).cast("timestamp_ntz")
    return batch.withColumns({
        "_ingested_at": ts,
        "_schema_version": F.lit(schema_version),
        "_source": F.lit(source),
        "_ingest_date": F.to_date(ts),
    })


def _widens(live: T.DataType, batch: T.DataType) -> bool:
    """Doubles do not fit a float column without loss; float files read as double do."""
    return isinstance(live, T.FloatType) and isinstance(batch, T.DoubleType)


def evolved_schema(live: T.StructType | None, batch: T.StructType) -> T.StructType:
    """Live schema plus the batch's new columns (appended, nullable) and widened ones."""
    if live is None:
        return batch
    names = set(live.fieldNames())
    wide = {f.name for f in batch.fields if f.name in names and _widens(live[f.name].dataType, f.dataType)}
    live = T.StructType([T.StructField(f.name, T.DoubleType(), f.nullable) if f.name in wide else f
                         for f in live.fields])
    extra = [T.StructField(f.name, f.dataType, True) for f in batch.fields if f.name not in names]
    return T.StructType(live.fields + extra)


def conform(spark: SparkSession, batch: DataFrame, lake: lk.Lake) -> DataFrame:
    """Cast columns already in Bronze to Bronze's physical type.

    The gate treats int/bigint (and timestamp/timestamp_ntz) as the same
    contract type, but Parquet files under one table must agree physically.
    """
    live = ct.live_schema(spark, lake.bronze)
    if live is None:
        return batch
    physical = {f.name: f.dataType for f in live.fields}
    return batch.select(*[
        F.col(c).cast(physical[c]).alias(c) if c in physical and physical[c] != batch.schema[c].dataType
        and not _widens(physical[c], batch.schema[c].dataType) else F.col(c) for c in batch.columns])


def first_arrival(spark: SparkSession, lake: lk.Lake, batch_id: str) -> dt.datetime | None:
    """Arrival stamp of a batch's first attempt, if there was one."""
    log = lk.read_log(spark, lake, "schema_change_log").filter(F.col("batch_id") == batch_id)
    return log.agg(F.min("arrived_at")).first()[0]


def ingest(spark: SparkSession, batch: DataFrame, lake: lk.Lake, *, batch_id: str,
           schema_version: str = "v1", ingested_at: dt.datetime | None = None,
           evaluated_at: dt.datetime | None = None, run_type: str = "incremental",
           source: str = PIPELINE_ID, seed_version: str = "v1",
           dbu_per_hour: float = cost.DBU_PER_HOUR, rate: float = cost.DBU_RATE_USD,
           admitted: Callable[[], None] | None = None) -> int:
    """Gate, log, enrich, append, count, cost.  Returns rows written.

    ``seed_version`` names the contract of an absent table: a seed version or
    the path of a contract file.  ``admitted`` writes what goes beside the
    batch: it is called once the gate has let the batch in, before Bronze is written.
    """
    started = time.monotonic()
    verdict, baseline = gate(spark, batch, lake, batch_id, seed_version)
    ingested_at = first_arrival(spark, lake, batch_id) or ingested_at or utc_now()
    route(spark, lake, verdict, baseline, evaluated_at or utc_now(), ingested_at)
    if admitted is not None:
        admitted()

    out = enrich(conform(spark, batch, lake), ingested_at, schema_version, source).withColumn(
        "_batch_id", F.lit(batch_id))
    live = ct.live_schema(spark, lake.bronze)
    schema = evolved_schema(live, out.schema)
    obs = Observation(f"ingest_{batch_id}")
    newest = F.max("updated_at").cast("timestamp_ntz") if "updated_at" in out.columns else F.lit(None).cast("timestamp_ntz")
    (out.observe(obs, F.count(F.lit(1)).alias("rows"), newest.alias("newest"))
        .write.mode("overwrite").options(partitionOverwriteMode="dynamic", **lk.COMPRESSED)
        .partitionBy("_ingest_date", "_batch_id").parquet(lake.bronze))
    rows = int(obs.get["rows"])
    if schema != live:
        # after the data: a failed first append leaves no baseline behind
        ct.write_table_schema(spark, lake.bronze, schema)
    lk.append_log(spark, lake, "batch_log", [
        (lk.new_run_id(), batch_id, ingested_at, rows, obs.get["newest"], utc_now())])
    log_cost(spark, lake, time.monotonic() - started, rows, run_type, source, dbu_per_hour=dbu_per_hour, rate=rate)
    return rows


def ingest_csv(spark: SparkSession, path: str, lake: lk.Lake, **settings) -> tuple[int, int]:
    """S3 + I1: a CSV batch through the gate, as its own headers name its columns."""
    return ingest_text(spark, path, lake, kind="csv", **settings)


def ingest_text(spark: SparkSession, path: str, lake: lk.Lake, *, batch_id: str, kind: str,
                schema_version: str = "v1", **settings) -> tuple[int, int]:
    """A batch of CSV or JSON-lines files through the gate.

    Lines that do not fit the contract's types are kept, as they stand, in the
    quarantine table under the batch id; a batch that the gate halts leaves none
    there.  Returns (rows ingested, lines quarantined).
    """
    declared = ct.contract_struct(ct.seed_contracts(spark, [schema_version]))
    batch = (files.read_csv_batch if kind == "csv" else files.read_json_batch)(spark, path, declared)
    obs = Observation(f"quarantine_{batch_id}")

    def quarantine() -> None:
        # before the batch is written: should the driver die between, a replay writes both again
        (files.malformed_rows(batch).select("*", F.lit(batch_id).alias("_batch_id")).observe(obs, F.count(F.lit(1)).alias("rows"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("_batch_id").parquet(lake.quarantine))

    rows = ingest(spark, batch.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record"), lake,
                  batch_id=batch_id, schema_version=schema_version, admitted=quarantine, **settings)
    return rows, int(obs.get["rows"])


def log_cost(spark: SparkSession, lake: lk.Lake, runtime_seconds: float, rows: int,
             run_type: str, pipeline: str = PIPELINE_ID, logged_at: dt.datetime | None = None,
             dbu_per_hour: float = cost.DBU_PER_HOUR, rate: float = cost.DBU_RATE_USD) -> None:
    runs = local_table(spark, [(pipeline, run_type, float(runtime_seconds), int(rows), logged_at or utc_now())],
        "pipeline_name string, run_type string, runtime_seconds double, rows_processed long, "
        "logged_at timestamp_ntz")
    lk.append_log(spark, lake, "cost_attribution_log", cost.with_cost(runs, dbu_per_hour, rate))
