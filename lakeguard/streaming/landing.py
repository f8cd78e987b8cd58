"""Guarded landing-zone ingest with Structured Streaming (operators S8, T1, T2).

Producers drop each batch as Parquet, CSV or JSON-lines files in its own
sub-directory of the landing folder, ``<landing>/<batch_id>/``, and finish it by
writing a ``batch.ready`` marker there (:func:`drop_batch` does both).  The
stream tracks the markers, not the data files: a batch is picked up only once it
is complete, never split across micro-batches, and ``maxFilesPerTrigger``
bounds the producer batches per micro-batch.  A file stream over the data
with a declared schema would also hide drift (extra columns silently
dropped), so no data file is read by the stream itself.  Each micro-batch
then, in ``foreachBatch``:

1. skips producer batches already committed (replay after a restart);
2. gates the batch by its format: Parquet by every file's own footer, read once
   (N8), CSV by every file's header, JSON by the fields its records hold; one
   breaking file makes the producer batch BREAKING;
3. BREAKING: an incident row is written and the stream stops by raising; the
   files stay where they are, and the next start replays the same
   micro-batch (same markers) from the checkpoint;
4. otherwise the files are read with the contract's types (Parquet: the widest
   physical type of each column), ingested (I1) and committed in ``run_log``;
   malformed text lines go to quarantine; a batch replayed after a crash
   replaces what its first attempt wrote;
5. optionally (``then``) Silver and Gold are brought up to date.

Late data (T2) is handled downstream by arrival-time merges, not by a
watermark that drops rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeguard.operators import drift
from lakeguard.plans import gates
from lakeguard.plans import ingest as ig
from lakeguard.plans import lake as lk
from lakeguard.sources import contracts as ct
from lakeguard.sources import files as fl


READY = "batch.ready"  # a producer batch's completion marker
# The binaryFile source's fixed schema (streams must declare it).
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def committed_batches(spark: SparkSession, lake: lk.Lake) -> DataFrame:
    return (lk.read_log(spark, lake, "run_log")
            .filter((F.col("stage") == "landing") & (F.col("status") == "committed"))
            .select(F.col("mode").alias("batch_id")).distinct())


def _format(spark: SparkSession, batch_dir: str) -> str:
    """Format of a batch by the ending its data files share."""
    fs, p = ct.hadoop_path(spark, batch_dir)
    found, walk = set(), fs.listFiles(p, True)
    while walk.hasNext():
        name = walk.next().getPath().getName()
        if not name.startswith(("_", ".")) and name != READY:
            found |= {f for f in ("parquet", "csv", "json") if f".{f}" in name}
    if len(found) > 1:
        raise ValueError(f"{batch_dir} mixes formats: {sorted(found)}")
    return found.pop() if found else "parquet"


def _parquet_batch(spark: SparkSession, lake: lk.Lake, batch_id: str, batch_dir: str, at) -> DataFrame:
    """The batch's rows, after each of its files has passed the gate (raises otherwise)."""
    path = lake.staging(f"landing-{batch_id}", "footers")     # each footer is read once
    fl.footers(fl.list_files(spark, batch_dir)).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(path)
    footers = spark.read.parquet(path)
    baseline, _ = ct.baseline_contract(spark, lake.bronze, "baseline")
    verdict = gates.batch_verdicts(gates.schema_changes(footers, baseline)).drop("baseline_key").first()
    schema, disagree = fl.common_schema(fl.distinct_contracts(footers))
    lk.delete_path(spark, lake.staging(f"landing-{batch_id}", "footers"))
    if disagree:  # files that no one schema can read
        verdict = verdict.asDict() | {"verdict": drift.BREAKING, "type_changes": str(disagree)}
    if verdict["verdict"] == drift.BREAKING:
        ig.route(spark, lake, dict(verdict.asDict() if hasattr(verdict, "asDict") else verdict), f"files of {batch_id}", at)  # raises
    return (spark.read.schema(schema).option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", True).parquet(batch_dir))


def refresh_models(spark: SparkSession, lake: lk.Lake, batch_ids: list[str]) -> None:
    """Hook for :func:`start`: bring Silver and Gold up to date after the
    micro-batch's producer batches were ingested (arrival-time merge, Gold
    by retraction)."""
    from lakeguard.plans import models
    models.silver_incremental(spark, lake, mode="arrival")
    models.gold_incremental(spark, lake, mode="touched_dates")


def process_microbatch(spark: SparkSession, lake: lk.Lake, markers: DataFrame,
                       schema_version: str = "v1", clock=ig.utc_now, then=None) -> list[str]:
    """Gate and ingest the producer batches of one micro-batch, in batch-id order."""
    with_batch = markers.select(
        F.regexp_replace("path", f"/{READY}$", "").alias("dir"),
        F.element_at(F.split("path", "/"), -2).alias("batch_id"))
    pending = with_batch.join(committed_batches(spark, lake), "batch_id", "left_anti")
    todo = sorted((r[0], r[1]) for r in pending.select("batch_id", "dir").distinct().collect())
    done = []
    for batch_id, batch_dir in todo:  # bounded by maxFilesPerTrigger
        settings = dict(batch_id=batch_id, schema_version=schema_version, ingested_at=clock(), evaluated_at=clock())
        kind = _format(spark, batch_dir)
        if kind == "parquet":
            ig.ingest(spark, _parquet_batch(spark, lake, batch_id, batch_dir, clock()), lake, **settings)
        else:
            ig.ingest_text(spark, batch_dir, lake, kind=kind, **settings)
        lk.append_log(spark, lake, "run_log", [(
            f"landing-{batch_id}", "landing", batch_id, "committed", None, None, None, None, clock(),
            lake.bronze, None, None)])
        done.append(batch_id)
    if then is not None and done:
        then(spark, lake, done)
    return done


def start(spark: SparkSession, landing: str, lake: lk.Lake, checkpoint: str,
          schema_version: str = "v1", available_now: bool = True, clock=ig.utc_now,
          then=None, max_batches_per_trigger: int = 100):
    """Start the landing stream; with ``available_now`` it drains what is there
    and stops.  ``then(spark, lake, batch_ids)`` runs after each micro-batch's
    ingests (e.g. :func:`refresh_models`).  Returns the StreamingQuery."""
    stream = (spark.readStream.format("binaryFile")
              .schema(BINARY_FILE_SCHEMA)
              .option("pathGlobFilter", READY)
              .option("recursiveFileLookup", "true")
              .option("maxFilesPerTrigger", max_batches_per_trigger)
              .load(landing)
              .select("path"))

    def each(batch_df: DataFrame, epoch_id: int) -> None:
        process_microbatch(spark, lake, batch_df, schema_version, clock, then)

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()


def drop_batch(batch: DataFrame, landing: str, batch_id: str, kind: str = "parquet") -> None:
    """Producer side: write one batch into its own landing sub-directory, then
    mark it complete."""
    target = f"{landing.rstrip('/')}/{batch_id}"
    batch.write.mode("errorifexists").format(kind).options(**{"header": "true"} if kind == "csv" else {}).save(target)
    spark = batch.sparkSession
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(f"{target}/{READY}")
    out = marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(marker, False)
    try:  # not empty: Spark's file listing skips zero-length files
        out.write(bytearray(f"{batch_id}\n".encode("utf-8")))
    finally:
        out.close()
