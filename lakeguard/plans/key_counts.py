"""Bronze's declared data tests, kept up batch by batch (operators Q1-Q3).

Bronze only grows, so its tests need not read it again.  A stored table holds
the rows per key of every batch, partitioned by the batch; ``data_test_log``
holds what each batch changed in the failures of each test.  A run

1. groups the batches in ``batch_log`` that no committed run has taken by
   (batch, key), with the null counts of every declared column beside the row
   count, and stages that: Bronze's other batches are not read;
2. sums, for the keys these batches hold and no others, the stored counts
   before and after: a key whose sum passes from at most one to more is one
   more failure of ``unique``, and one that falls back is one less.  A batch
   delivered again replaces its stored counts, so what it held before is
   retracted;
3. logs the changes as ``planned``, overwrites the batches' partitions of the
   stored table and logs the changes as ``committed``.

Failures are the sum of the committed changes.  A run that was planned but not
committed is done again from its staging table: its changes were fixed before
the stored table was touched, so nothing is counted twice.

A hot key is one row per map task in step 1 and one row per batch in step 2.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeguard.operators import quality
from lakeguard.plans import lake as lk
from lakeguard.plans import models
from lakeguard.plans.ingest import utc_now
from lakeguard.session import local_table

TABLE = "bronze.raw_orders"
KEY = quality.DECLARED[TABLE]["unique"][0]
NOT_NULL = quality.DECLARED[TABLE]["not_null"]
BATCH = "_batch_id"


def stored(spark: SparkSession, lake: lk.Lake, key: T.DataType) -> DataFrame:
    """Rows per (batch, key) of the batches taken so far; no key is lost, null included."""
    schema = T.StructType([T.StructField("key", key), T.StructField("n", T.LongType()), T.StructField(BATCH, T.StringType())])
    return lk.read_or_empty(spark, lake.bronze_keys, schema)


def _log(spark: SparkSession, lake: lk.Lake) -> DataFrame:
    return lk.read_log(spark, lake, "data_test_log")


def _committed(spark: SparkSession, lake: lk.Lake) -> DataFrame:
    return _log(spark, lake).where("status = 'committed'")


def _publish(spark: SparkSession, lake: lk.Lake, run_id: str, changes: list) -> None:
    """Replace the partitions of a staged run's batches, and commit its changes."""
    rows = spark.read.parquet(lake.staging(run_id, "keys"))
    lk.overwrite_partitions(rows.select("key", "n", BATCH), lake.bronze_keys, BATCH, [], f"keys_{run_id}")
    _append(spark, lake, run_id, "committed", changes)
    lk.delete_path(spark, lake.staging(run_id, "keys"))


def _append(spark, lake, run_id, status, changes) -> None:
    now = utc_now()
    lk.append_log(spark, lake, "data_test_log", [(run_id, status, *c, now) for c in changes])


def _finish(spark: SparkSession, lake: lk.Lake) -> None:
    """Do the runs again that were planned but not committed (normally none)."""
    log = _log(spark, lake)
    left = log.where("status = 'planned'").join(_committed(spark, lake).select("run_id").distinct(), "run_id", "left_anti")
    runs: dict[str, list] = {}
    for r in left.orderBy("logged_at", "run_id").collect():
        runs.setdefault(r["run_id"], []).append((r["source_id"], r["batch_id"], r["column_name"], r["test"], r["change"]))
    for run_id, changes in runs.items():
        _publish(spark, lake, run_id, changes)


def _unique_change(staged: DataFrame, before: DataFrame, batches: list[str]) -> int:
    """By how much the keys with more than one row become more once ``staged`` replaces its batches."""
    mine = F.col(BATCH).isin(batches)
    affected = staged.select("key").union(before.where(mine).select("key")).where("key is not null").distinct()
    counts = (before.join(affected, "key", "left_semi")
              .select("key", F.col("n").alias("was"), F.when(mine, 0).otherwise(F.col("n")).alias("now"))
              .unionByName(staged.where("key is not null").select("key", F.lit(0).alias("was"), F.col("n").alias("now"))))
    sums = counts.groupBy("key").agg(F.sum("was").alias("was"), F.sum("now").alias("now"))
    return sums.agg((F.count_if(F.col("now") > 1) - F.count_if(F.col("was") > 1)).alias("c")).first()["c"]


def update(spark: SparkSession, lake: lk.Lake, run_id: str | None = None) -> int:
    """Take the batches that arrived since the last run; returns how many."""
    _finish(spark, lake)
    taken = _committed(spark, lake).select("source_id").distinct()
    writes = lk.read_log(spark, lake, "batch_log").join(taken, "source_id", "left_anti").select(
        "source_id", "batch_id", "ingested_at").collect()
    if not writes:
        return 0
    run_id = run_id or lk.new_run_id()
    batches = sorted({w["batch_id"] for w in writes})
    # both are partition columns: only the new batches' files are read
    rows = models._bronze(spark, lake).where(
        F.col("_ingest_date").isin(sorted({w["ingested_at"].date() for w in writes})) & F.col(BATCH).isin(batches))
    nulls = {f"null_{i}": c for i, c in enumerate(NOT_NULL)}
    keyed = rows.groupBy(F.col(BATCH).cast("string").alias(BATCH), F.col(KEY).alias("key")).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(a) for a, c in nulls.items()])
    path = lake.staging(run_id, "keys")
    keyed.write.mode("overwrite").parquet(path)
    staged = spark.read.parquet(path)
    duplicates = _unique_change(staged, stored(spark, lake, staged.schema["key"].dataType), batches)

    found = {r[BATCH]: r for r in staged.groupBy(BATCH).agg(*[F.sum(a).alias(a) for a in nulls]).collect()}
    names = local_table(spark, [(b,) for b in batches], "batch_id string")
    before = {(r["batch_id"], r["column_name"]): r["n"] for r in
              _committed(spark, lake).where("test = 'not_null'").join(names, "batch_id", "left_semi")
              .groupBy("batch_id", "column_name").agg(F.sum("change").alias("n")).collect()}
    changes, seen = [], set()
    for w in writes:
        b = w["batch_id"]
        again, row = b in seen, found.get(b)   # of several writes of a batch one carries its changes
        seen.add(b)
        changes += [(w["source_id"], b, c, "not_null", 0 if again else (row[a] if row else 0) - before.get((b, c), 0))
                    for a, c in nulls.items()]
    changes.append((writes[0]["source_id"], writes[0]["batch_id"], KEY, "unique", duplicates))
    _append(spark, lake, run_id, "planned", changes)
    _publish(spark, lake, run_id, changes)
    return len(batches)


def report(spark: SparkSession, lake: lk.Lake) -> DataFrame:
    """The rows of ``quality.report`` for Bronze, from the log alone."""
    tests = [(c, "not_null") for c in NOT_NULL] + [(KEY, "unique")]
    declared = local_table(spark, tests, "column_name string, test string")
    sums = _committed(spark, lake).groupBy("column_name", "test").agg(F.sum("change").alias("failures"))
    return declared.join(sums, ["column_name", "test"], "left").select(
        F.lit(TABLE).alias("table_name"), "column_name", "test", F.coalesce("failures", F.lit(0)).cast("long").alias("failures"),
        F.when(F.coalesce("failures", F.lit(0)) == 0, "PASS").otherwise("FAIL").alias("status"))
