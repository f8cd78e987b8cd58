"""Table layout and the write primitives (sinks K1-K3, K7).

One root folder (a shared filesystem or object store path on a cluster)
holds four areas: ``bronze``, ``silver``, ``gold`` and ``observability``,
plus ``_staging`` for run-scoped intermediate tables.  All tables are plain
Parquet:

* Bronze ``raw_orders``: partitioned by ``_ingest_date`` and ``_batch_id``, so
  arrival deltas and per-day completeness prune to the batches and days they
  need and a replayed batch replaces itself; batches are only added, and new
  upstream columns with them.
* Silver ``orders_cleaned``: partitioned by ``_part`` = created month
  (yyyymm).  A merge rewrites only the months of the keys it changes.
* Gold ``daily_revenue``: one row per date, partitioned by ``_year``, with the
  exact sums behind its averages in columns that begin with an underscore.
* Logs: append-only tables, partitioned by the day they were written on.

Tables are rewritten partition by partition with the engine's own dynamic
partition overwrite (:func:`overwrite_partitions`).
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeguard.session import local_table
from lakeguard.sources.contracts import hadoop_path, path_exists

COMPRESSED = {"compression": "zstd"}   # of the tables that hold a row per order or version, and of their staging
LOG_DAY = "_day"   # partition column of the logs: the UTC day of the append

LOG_SCHEMAS = {
    "schema_change_log": T.StructType([
        T.StructField("evaluated_at", T.TimestampNTZType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("verdict", T.StringType()),
        T.StructField("added_columns", T.StringType()),
        T.StructField("removed_columns", T.StringType()),
        T.StructField("type_changes", T.StringType()),
        T.StructField("affected_pipelines", T.StringType()),
        T.StructField("baseline", T.StringType()),
        T.StructField("arrived_at", T.TimestampNTZType()),
    ]),
    "sla_check_log": T.StructType([
        T.StructField("check_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("detail", T.StringType()),
        T.StructField("business_impact", T.StringType()),
        T.StructField("checked_at", T.TimestampNTZType()),
    ]),
    "cost_attribution_log": T.StructType([
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("run_type", T.StringType()),
        T.StructField("runtime_seconds", T.DoubleType()),
        T.StructField("rows_processed", T.LongType()),
        T.StructField("estimated_dbu", T.DoubleType()),
        T.StructField("estimated_cost_usd", T.DoubleType()),
        T.StructField("logged_at", T.TimestampNTZType()),
        T.StructField("methodology", T.StringType()),
    ]),
    "run_log": T.StructType([
        T.StructField("run_id", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("mode", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("watermark_updated_at", T.TimestampNTZType()),
        T.StructField("watermark_ingested_at", T.TimestampNTZType()),
        T.StructField("watermark_order_date", T.DateType()),
        T.StructField("committed_at", T.TimestampNTZType()),
        T.StructField("target", T.StringType()),
        T.StructField("partitions", T.StringType()),
        T.StructField("sources", T.StringType()),
    ]),
}
# One row per write of a batch to Bronze, with what was observed on that write.
LOG_SCHEMAS["batch_log"] = T.StructType([
    T.StructField("source_id", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("ingested_at", T.TimestampNTZType()),
    T.StructField("rows", T.LongType()),
    T.StructField("latest_updated_at", T.TimestampNTZType()),
    T.StructField("logged_at", T.TimestampNTZType()),
])
# What a batch changed in the failures of each declared test of Bronze.
LOG_SCHEMAS["data_test_log"] = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("source_id", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("test", T.StringType()),
    T.StructField("change", T.LongType()),
    T.StructField("logged_at", T.TimestampNTZType()),
])
LOG_SCHEMAS["incident_log"] = T.StructType(
    LOG_SCHEMAS["schema_change_log"].fields + [T.StructField("event", T.StringType())])


@dataclass(frozen=True)
class Lake:
    root: str

    def table(self, area: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{area}/{name}"

    @property
    def bronze(self) -> str:
        return self.table("bronze", "raw_orders")

    @property
    def quarantine(self) -> str:
        return self.table("bronze", "raw_orders_quarantine")

    @property
    def bronze_keys(self) -> str:
        return self.table("observability", "raw_orders_keys")

    @property
    def silver(self) -> str:
        return self.table("silver", "orders_cleaned")

    @property
    def gold(self) -> str:
        return self.table("gold", "daily_revenue")

    def log(self, name: str) -> str:
        if name not in LOG_SCHEMAS:
            raise KeyError(name)
        return self.table("observability", name)

    def staging(self, run_id: str, name: str) -> str:
        return self.table("_staging", f"{run_id}/{name}")


def new_run_id() -> str:
    return uuid.uuid4().hex[:12]


def exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path)


def read(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return local_table(spark, [], schema)


def append_log(spark: SparkSession, lake: Lake, name: str, rows: DataFrame | list) -> None:
    """Append log rows (K3).  Rows come either as a DataFrame derived from a
    Spark result or as a short list of tuples; the schema is always the
    table's explicit one, so an empty append still has a schema."""
    schema = LOG_SCHEMAS[name]
    df = rows if isinstance(rows, DataFrame) else local_table(spark, rows, schema)
    today = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d")
    df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]) \
        .coalesce(1).write.mode("append").parquet(f"{lake.log(name)}/{LOG_DAY}={today}")


def read_log(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    schema = LOG_SCHEMAS[name]
    day = T.StructType([*schema.fields, T.StructField(LOG_DAY, T.IntegerType())])
    return read_or_empty(spark, lake.log(name), day).select(*schema.fieldNames())


def silver_partition() -> Column:
    """Created month; rows without one have a partition of their own, 0."""
    month = F.year("created_at") * 100 + F.month("created_at")
    return F.coalesce(month, F.lit(0)).cast("int")


def gold_partition() -> Column:
    """Year; the row of orders without a date has a partition of its own, 0."""
    return F.coalesce(F.year("order_date"), F.lit(0)).cast("int")


def reset(spark: SparkSession, lake: Lake, silver: T.StructType, gold: T.StructType) -> None:
    """K7: Bronze is dropped with its schema (so the next run seeds the
    contract from v1 again); every other table is emptied and keeps its schema,
    Silver and Gold that of their models.  Errors propagate."""
    delete_path(spark, lake.bronze)
    delete_path(spark, lake.quarantine)
    delete_path(spark, lake.bronze_keys)
    delete_path(spark, lake.table("_staging", "").rstrip("/"))
    empty = {lake.silver: silver, lake.gold: gold} | {lake.log(n): schema for n, schema in LOG_SCHEMAS.items()}
    for path, schema in empty.items():
        if exists(spark, path):
            delete_path(spark, path)
            local_table(spark, [], schema).write.parquet(path)


def partitions_of(spark: SparkSession, path: str, column: str) -> list[str]:
    """Partition values of a table as their folders name them (a listing, no data read)."""
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    if fs.exists(p) and not fs.delete(p, True):
        raise OSError(f"could not delete {path}")


def overwrite_partitions(df: DataFrame, path: str, column: str, touched: list[str], name: str, *metrics) -> dict:
    """Replace the partitions of ``df`` by the engine's dynamic partition overwrite.

    ``df`` may read the table itself: its files are replaced only after the last
    task has ended.  Partitions of ``touched`` that ``df`` has no row for are
    deleted afterwards.  Done again with the same rows, it ends in the same table.
    Returns the metrics, which are observed on the write, and ``written``.
    """
    spark = df.sparkSession
    obs = Observation(name)
    # Rows of a partition meet for few files each; AQE splits a hot one over several tasks and merges small ones.
    out = df.hint("rebalance", column).observe(obs, F.collect_set(column).alias("written"), *metrics)
    out.write.mode("overwrite").options(partitionOverwriteMode="dynamic", **COMPRESSED).partitionBy(column).parquet(path)
    seen = obs.get
    for value in set(touched) - {str(v) for v in seen["written"]}:
        delete_path(spark, f"{path}/{column}={value}")
    return seen


def compact_log(spark: SparkSession, lake: Lake, name: str, target_bytes: int = 128 << 20,
                before: int | None = None) -> dict[int, int]:
    """Rewrite the closed days of a log as files of about ``target_bytes``.

    A day is closed once writers have gone on to the next; those of today are
    left alone, so writers need not stop.  Days are rewritten by as many tasks as
    their bytes need.  The new files are staged whole before they replace the old
    ones, so an interrupted call is finished by the next.  Returns files by day.
    """
    path, staged = lake.log(name), lake.table("_staging", f"compact_{name}")
    today = int(dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d")) if before is None else before
    fs, _ = hadoop_path(spark, path)

    def files(folder: str) -> list[int]:
        _, p = hadoop_path(spark, folder)
        return [st.getLen() for st in fs.listStatus(p) if st.getPath().getName().endswith(".parquet")] if fs.exists(p) else []

    def publish() -> None:
        rows = spark.read.schema(T.StructType([*LOG_SCHEMAS[name].fields, T.StructField(LOG_DAY, T.IntegerType())])).parquet(staged)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LOG_DAY).parquet(path)
        delete_path(spark, staged)

    if exists(spark, f"{staged}/_SUCCESS"):      # staged by a call that did not end
        publish()
    delete_path(spark, staged)
    made = {}
    for day in partitions_of(spark, path, LOG_DAY):
        sizes = files(f"{path}/{LOG_DAY}={day}")
        wanted = max(1, -(-sum(sizes) // target_bytes))
        if int(day) < today and len(sizes) > wanted:
            made[int(day)] = wanted
    if not made:
        return {}
    for day, wanted in made.items():
        rows = spark.read.schema(LOG_SCHEMAS[name]).parquet(f"{path}/{LOG_DAY}={day}")
        rows.repartition(wanted).write.mode("overwrite").parquet(f"{staged}/{LOG_DAY}={day}")
    fs.create(hadoop_path(spark, f"{staged}/_SUCCESS")[1], True).close()
    publish()
    return made
