"""Model runs that write Silver and Gold (operators K4, K5, K6, M1-M3).

Every run goes the same way, and may be done again at any point:

1. what decides the result is written to a run-scoped staging table: for Silver
   the change set (per changed ``order_id`` its new row, and of the row it
   replaces what Gold counts), for Gold the finished rows of the touched years.
   A written table cuts the lineage, so a lost executor recomputes from it, not
   from Bronze;
2. the touched partitions, with the sources the run takes, are logged as
   ``planned``;
3. the touched partitions are replaced by the engine's dynamic partition
   overwrite, and those left without rows are deleted;
4. one ``committed`` row is logged.

A run that was planned but not committed is done again by the next one from
step 3 on.  That ends in the same table: a merge of the same change set over
its own result changes nothing, and Gold's rows are finished before they are
published.  Should the driver die while the engine swaps a partition in, that
partition may be missing; its rows are then taken from Bronze's batches.

What a run has to take is not guessed from timestamps: ``batch_log`` names every
batch written to Bronze, and ``run_log`` the sources each run took.  Silver
takes the batches, and Gold the Silver runs, that no committed run of theirs has
taken, so late or equal stamps and interrupted runs lose nothing.

Gold is maintained from Silver's change sets: the old version of a changed row
is retracted from its date and the new one added (``gold.retraction``), so an
incremental run reads no Silver file.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeguard.operators import drift
from lakeguard.plans import gold as gd
from lakeguard.plans import lake as lk
from lakeguard.plans import silver as sv
from lakeguard.plans.ingest import utc_now
from lakeguard.session import local_table
from lakeguard.sources import contracts as ct

PART, YEAR = "_part", "_year"


@contextmanager
def _step(timings: dict, name: str):
    t0 = time.perf_counter()
    yield
    timings[name] = round(time.perf_counter() - t0, 3)


class SinkSchemaDrift(Exception):
    """Model output no longer matches its target table's contract (K6)."""


# ------------------------------------------------------------------ run log
MARKS = ("rows", "watermark_updated_at", "watermark_ingested_at", "watermark_order_date")


def _log(spark, lake, run_id, stage, mode, status, target, partitions, sources, **marks) -> None:
    lk.append_log(spark, lake, "run_log", [(
        run_id, stage, mode, status, *[marks.get(m) for m in MARKS], utc_now(), target,
        ",".join(map(str, partitions)), ",".join(sorted(set(sources))))])


def _committed(spark: SparkSession, lake: lk.Lake, stage: str) -> DataFrame:
    return lk.read_log(spark, lake, "run_log").filter(
        (F.col("stage") == stage) & (F.col("status") == "committed"))


def _taken(spark: SparkSession, lake: lk.Lake, stage: str) -> DataFrame:
    """Sources that the committed runs of ``stage`` took."""
    return _committed(spark, lake, stage).select(F.explode(F.split("sources", ",")).alias("source_id"))


def _new_batches(spark: SparkSession, lake: lk.Lake) -> list:
    """Batches in Bronze that no committed Silver run has taken: one log row each."""
    log = lk.read_log(spark, lake, "batch_log").select("source_id", "batch_id", "ingested_at")
    return log.join(_taken(spark, lake, "silver"), "source_id", "left_anti").collect()


def _new_silver_runs(spark: SparkSession, lake: lk.Lake) -> list:
    """Committed Silver runs with changes that no committed Gold run has taken."""
    runs = _committed(spark, lake, "silver").filter(F.col("partitions") != "").select(
        F.col("run_id").alias("source_id"), "mode", "partitions").distinct()
    return runs.join(_taken(spark, lake, "gold"), "source_id", "left_anti").collect()


def _open_run(spark: SparkSession, lake: lk.Lake, stage: str):
    """The last committed run of ``stage``; a run that was planned but not committed is finished first."""
    row = F.struct(*lk.LOG_SCHEMAS["run_log"].fieldNames())
    runs = (lk.read_log(spark, lake, "run_log").filter(F.col("stage") == stage).groupBy("run_id")
            .agg(F.max_by(row, F.col("status") == "committed").alias("r")))
    done = F.col("r.status") == "committed"
    state = runs.agg(F.max_by(F.when(done, F.col("r")), F.when(done, F.struct("r.committed_at", "run_id"))).alias("last"),
                     F.collect_list(F.when(~done, F.col("r"))).alias("open")).first()
    for r in sorted(state["open"], key=lambda r: r["committed_at"]):  # an interrupted run: normally none
        replay(spark, lake, r)
    return _open_run(spark, lake, stage) if state["open"] else state["last"]


def last_run(spark: SparkSession, lake: lk.Lake, stage: str):
    """Log row of the last committed run of ``stage``."""
    row = F.struct(*lk.LOG_SCHEMAS["run_log"].fieldNames())
    return _committed(spark, lake, stage).agg(F.max_by(row, F.struct("committed_at", "run_id")).alias("r")).first()["r"]


def replay(spark: SparkSession, lake: lk.Lake, run) -> None:
    """Do a planned run again from its staging table."""
    parts = run["partitions"].split(",") if run["partitions"] else []
    sources = run["sources"].split(",") if run["sources"] else []
    marks = {m: run[m] for m in MARKS}
    if run["mode"] == "full_refresh":
        (silver_full_refresh if run["stage"] == "silver" else gold_full_refresh)(spark, lake, run_id=run["run_id"])
    elif run["stage"] == "silver":
        _publish_silver(spark, lake, run["run_id"], run["mode"], parts, sources, marks)
    else:
        _publish_gold(spark, lake, run["run_id"], run["mode"], parts, sources, marks)


# ------------------------------------------------------------------ checks
def check_sink_contract(spark: SparkSession, output: DataFrame, target_path: str,
                        ignore: Sequence[str] = (), target: DataFrame | None = None) -> None:
    """K6: the model's output contract must equal the target's (on_schema_change=fail).

    Pass ``target`` when the run has already
    opened the target table, to avoid listing it again."""
    if target is None:
        if not lk.exists(spark, target_path):
            return
        target = spark.read.parquet(target_path)
    keep = lambda s: T.StructType([f for f in s.fields if f.name not in ignore])
    if ct.same_contract(keep(output.schema), keep(target.schema), drop_system=False):
        return
    pair = local_table(spark, [("output", "target")], "batch_id string, baseline_key string")
    bad = drift.column_changes(ct.contract_of(spark, {"output": keep(output.schema)}, drop_system=False),
                               ct.contract_of(spark, {"target": keep(target.schema)}, drop_system=False),
                               pair).where(F.col("change") != drift.SAME).orderBy("column_name").collect()
    if bad:
        raise SinkSchemaDrift(f"{target_path}: " + ", ".join(f"{r.column_name} {r.change}" for r in bad))


# ------------------------------------------------------------------ Silver
def _bronze(spark: SparkSession, lake: lk.Lake) -> DataFrame:
    """Bronze with its recorded schema: no footer inference over its files."""
    return spark.read.schema(ct.live_schema(spark, lake.bronze)).parquet(lake.bronze)


def silver_table(spark: SparkSession, lake: lk.Lake) -> DataFrame:
    """The Silver model's columns."""
    return spark.read.parquet(lake.silver).select(*sv.SILVER_COLUMNS)


def gold_table(spark: SparkSession, lake: lk.Lake) -> DataFrame:
    """The Gold model's columns."""
    return spark.read.parquet(lake.gold).select(*gd.GOLD_COLUMNS)


def _with_part(rows: DataFrame) -> DataFrame:
    return rows.withColumn(PART, lk.silver_partition())


def _latest(*values):
    return max((v for v in values if v is not None), default=None)


def silver_full_refresh(spark: SparkSession, lake: lk.Lake,
                        version_order: Sequence[str] = sv.DEFAULT_VERSION_ORDER,
                        run_id: str | None = None) -> dict:
    """K5: rebuild Silver from all of Bronze (latest version per key)."""
    run_id = run_id or lk.new_run_id()
    timings: dict[str, float] = {}
    sources = [b["source_id"] for b in _new_batches(spark, lake)]  # before Bronze is read: it holds all of these
    before = lk.partitions_of(spark, lake.silver, PART)
    _log(spark, lake, run_id, "silver", "full_refresh", "planned", lake.silver, before, sources)
    with _step(timings, "build"):
        seen = lk.overwrite_partitions(
            _with_part(sv.silver_full(_bronze(spark, lake), version_order)), lake.silver, PART, before, f"silver_{run_id}",
            F.count(F.lit(1)).alias("rows"), F.max("updated_at").alias("max_updated"), F.max("_ingested_at").alias("max_ingested"))
    _log(spark, lake, run_id, "silver", "full_refresh", "committed", lake.silver, sorted(seen["written"]), sources,
         rows=seen["rows"], watermark_updated_at=seen["max_updated"], watermark_ingested_at=seen["max_ingested"])
    return {"run_id": run_id, "rows": seen["rows"], "mode": "full_refresh", "partitions": len(seen["written"]), "timings": timings}


def _rebuilt(spark: SparkSession, lake: lk.Lake, months: list[str], sources: list[str]) -> DataFrame:
    """Silver rows of ``months`` from the Bronze batches that the committed runs and ``sources`` took."""
    taken = _taken(spark, lake, "silver").unionByName(local_table(spark, [(s,) for s in sources], "source_id string"))
    batches = lk.read_log(spark, lake, "batch_log").join(taken, "source_id", "left_semi").select("batch_id").distinct()
    bronze = _bronze(spark, lake).join(batches.withColumnRenamed("batch_id", "_batch_id"), "_batch_id", "left_semi")
    return _with_part(sv.silver_full(bronze)).filter(F.col(PART).isin([int(m) for m in months])).drop(PART)


def _publish_silver(spark: SparkSession, lake: lk.Lake, run_id: str, mode: str, parts: list[str], sources: list[str],
                    marks: dict) -> None:
    """Merge a staged change set into the touched months, and commit.

    ``parts``: the touched months, with a ``+`` before those that the table did not have.
    """
    touched = [p.lstrip("+") for p in parts]
    if touched:
        there = set(lk.partitions_of(spark, lake.silver, PART))
        lost = [p for p in parts if not p.startswith("+") and p not in there]
        changes = spark.read.parquet(lake.staging(run_id, "changes"))
        table = spark.read.schema(changes.drop("_side").schema).parquet(lake.silver)  # also of a table that lost all its months
        current = table.filter(F.col(PART).isin([int(p) for p in touched])).select(*sv.SILVER_COLUMNS)
        if lost:
            current = current.unionByName(_rebuilt(spark, lake, lost, sources))
        merged = sv.merge_changes(current, changes.filter(F.col("_side") == "new"))
        lk.overwrite_partitions(_with_part(merged), lake.silver, PART, touched, f"silver_{run_id}")
    _log(spark, lake, run_id, "silver", mode, "committed", lake.silver, touched, sources, **marks)


def silver_incremental(spark: SparkSession, lake: lk.Lake, mode: str = "arrival",
                       version_order: Sequence[str] = sv.DEFAULT_VERSION_ORDER,
                       run_id: str | None = None) -> dict:
    """K4/M1 incremental run; the first run (no Silver yet) is a full refresh.

    ``arrival`` takes the batches that no committed run has taken;
    ``event_time`` is the reference's rule and, like it, skips rows that are
    not newer than the last run's newest one (a later ``arrival`` run still
    takes them).
    """
    if mode not in ("arrival", "event_time"):
        raise ValueError(f"unknown incremental mode {mode!r}")
    last = _open_run(spark, lake, "silver")
    there = lk.partitions_of(spark, lake.silver, PART)
    if not there:
        return silver_full_refresh(spark, lake, version_order, run_id)
    run_id = run_id or lk.new_run_id()
    timings: dict[str, float] = {}
    previous = {m: last[m] if last else None for m in MARKS[1:]}
    target = spark.read.parquet(lake.silver)
    bronze = _bronze(spark, lake)
    wm, sources = None, []
    if mode == "event_time":
        wm = last["watermark_updated_at"] if last else target.agg(F.max("updated_at")).first()[0]
    else:
        batches = _new_batches(spark, lake)
        sources = [b["source_id"] for b in batches]
        if not batches:
            _publish_silver(spark, lake, run_id, mode, [], [], previous | {"rows": 0})
            return {"run_id": run_id, "rows": 0, "mode": mode, "partitions": 0, "touched_months": [], "timings": timings}
        # both are partition columns: only the new batches' files are read
        bronze = bronze.filter(F.col("_ingest_date").isin(sorted({b["ingested_at"].date() for b in batches}))
                               & F.col("_batch_id").isin(sorted({b["batch_id"] for b in batches})))
    stage = sv.staged_change_set(bronze, target, lk.silver_partition(), mode=mode,
                                 watermark=F.lit(wm.isoformat(sep=" ")).cast("timestamp_ntz") if wm else None,
                                 version_order=version_order)
    check_sink_contract(spark, stage.select(*sv.SILVER_COLUMNS), lake.silver, ignore=[PART], target=target)

    # the changed keys' new rows and what Gold counts of the rows they replace,
    # in one job; touched months, row count and watermarks are observed on that
    # write (months come back to the driver: they are bounded by the calendar)
    is_new, obs = F.col("_side") == "new", Observation(f"changes_{run_id}")
    with _step(timings, "stage_changes"):
        stage.observe(obs, F.array_sort(F.collect_set(PART)).alias("parts"), F.count_if(is_new).alias("rows"),
                      F.max(F.when(is_new, F.col("updated_at"))).alias("max_updated"),
                      F.max(F.when(is_new, F.col("_ingested_at"))).alias("max_ingested")
                      ).write.mode("overwrite").options(**lk.COMPRESSED).parquet(lake.staging(run_id, "changes"))
        seen = obs.get
    parts = [str(p) if str(p) in there else f"+{p}" for p in seen["parts"]]
    marks = previous | {"rows": seen["rows"], "watermark_updated_at": _latest(previous["watermark_updated_at"], seen["max_updated"]),
                        "watermark_ingested_at": _latest(previous["watermark_ingested_at"], seen["max_ingested"])}
    if parts:  # without changes there is nothing to do again
        _log(spark, lake, run_id, "silver", mode, "planned", lake.silver, parts, sources, **marks)
    with _step(timings, "publish"):
        _publish_silver(spark, lake, run_id, mode, parts, sources, marks)
    return {"run_id": run_id, "rows": seen["rows"], "mode": mode, "partitions": len(parts),
            "touched_months": list(seen["parts"]), "timings": timings}


# -------------------------------------------------------------------- Gold
def _with_year(rows: DataFrame) -> DataFrame:
    return rows.withColumn(YEAR, lk.gold_partition())


def _drop_changes(spark: SparkSession, lake: lk.Lake, run_ids) -> None:
    """Change sets are staging of Silver runs: gone once Gold took them."""
    for r in run_ids:
        lk.delete_path(spark, lake.staging(r, "changes"))


def gold_full_refresh(spark: SparkSession, lake: lk.Lake, run_id: str | None = None) -> dict:
    """K5: rebuild Gold from all of Silver."""
    run_id = run_id or lk.new_run_id()
    sources = [r["source_id"] for r in _new_silver_runs(spark, lake)]
    before = lk.partitions_of(spark, lake.gold, YEAR)
    _log(spark, lake, run_id, "gold", "full_refresh", "planned", lake.gold, before, sources)
    seen = lk.overwrite_partitions(_with_year(gd.daily_state(spark.read.parquet(lake.silver))), lake.gold, YEAR, before,
                                   f"gold_{run_id}", F.count(F.lit(1)).alias("rows"), F.max(gd.KEY).alias("max_date"))
    _log(spark, lake, run_id, "gold", "full_refresh", "committed", lake.gold, sorted(seen["written"]), sources,
         rows=seen["rows"], watermark_order_date=seen["max_date"])
    _drop_changes(spark, lake, sources)
    return {"run_id": run_id, "rows": seen["rows"], "mode": "full_refresh"}


def _publish_gold(spark: SparkSession, lake: lk.Lake, run_id: str, mode: str, years: list[str], sources: list[str],
                  marks: dict) -> None:
    """Replace the touched years by their staged rows, and commit."""
    if years:
        lk.overwrite_partitions(spark.read.parquet(lake.staging(run_id, "gold")), lake.gold, YEAR, years, f"gold_{run_id}")
    _log(spark, lake, run_id, "gold", mode, "committed", lake.gold, years, sources, **marks)
    _drop_changes(spark, lake, sources)
    lk.delete_path(spark, lake.staging(run_id, "gold"))


def gold_incremental(spark: SparkSession, lake: lk.Lake, mode: str = "touched_dates", run_id: str | None = None) -> dict:
    """M2 incremental: ``latest_date`` (reference rule) or ``touched_dates``.

    ``touched_dates`` adds the change sets of every committed Silver run that no
    Gold run has taken to the dates they touch.  A full refresh of Silver among
    them, or a ``latest_date`` run before (which leaves older dates behind),
    makes this a full refresh.
    """
    if mode not in ("touched_dates", "latest_date"):
        raise ValueError(f"unknown gold mode {mode!r}")
    last = _open_run(spark, lake, "gold")
    runs = _new_silver_runs(spark, lake) if mode == "touched_dates" else []
    behind = last is not None and last["mode"] == "latest_date" and mode == "touched_dates"
    if not lk.partitions_of(spark, lake.gold, YEAR) or behind or any(r["mode"] == "full_refresh" for r in runs):
        return gold_full_refresh(spark, lake, run_id)
    run_id = run_id or lk.new_run_id()
    target = spark.read.parquet(lake.gold)
    previous = last["watermark_order_date"] if last else None
    sources = [r["source_id"] for r in runs]
    if mode == "latest_date":
        wm = previous if last else target.agg(F.max(gd.KEY)).first()[0]
        silver = spark.read.parquet(lake.silver)
        first = wm.year * 100 + wm.month if wm is not None else None
        if first is not None:  # Silver months before the watermark's are not read
            silver = silver.filter(F.col(PART) >= first)
        recomputed = gd.daily_state(gd.gold_delta(silver, F.lit(wm) if wm else None))
        months = [int(m) for m in lk.partitions_of(spark, lake.silver, PART) if m.isdigit()]
        # a rewritten year keeps every row that is not recomputed
        years = sorted({m // 100 for m in months if first is None or m >= first})
        made = gd.merge_gold(target.filter(F.col(YEAR).isin(years)), recomputed)
    else:
        # the years of the months that the Silver runs touched: no job, no Silver file
        years = sorted({int(m) // 100 for r in runs for m in r["partitions"].split(",")})
        if years:
            changes = spark.read.parquet(*[lake.staging(s, "changes") for s in sources])
            made = gd.add_changes(target.filter(F.col(YEAR).isin(years)), gd.retraction(changes))
    if not years:
        _publish_gold(spark, lake, run_id, mode, [], sources, {"rows": 0, "watermark_order_date": previous})
        return {"run_id": run_id, "rows": 0, "mode": mode, "years": 0}
    check_sink_contract(spark, made, lake.gold, ignore=[YEAR], target=target)
    obs = Observation(f"gold_rows_{run_id}")
    (_with_year(made).observe(obs, F.count(F.lit(1)).alias("rows"), F.max(gd.KEY).alias("max_date"))
     .write.mode("overwrite").parquet(lake.staging(run_id, "gold")))
    marks = {"rows": obs.get["rows"], "watermark_order_date": _latest(previous, obs.get["max_date"])}
    _log(spark, lake, run_id, "gold", mode, "planned", lake.gold, years, sources, **marks)
    _publish_gold(spark, lake, run_id, mode, [str(y) for y in years], sources, marks)
    return {"run_id": run_id, "rows": marks["rows"], "mode": mode, "years": len(years)}


def reset(spark: SparkSession, lake: lk.Lake) -> None:
    """K7 with the schemas of the two models, so that readers of the emptied tables find them."""
    seeds = ct.contract_struct(ct.seed_contracts(spark, ["v1"]))
    audit = [T.StructField("_ingested_at", T.TimestampNTZType()), T.StructField("_schema_version", T.StringType()),
             T.StructField("_source", T.StringType())]
    silver = sv.project(local_table(spark, [], T.StructType([*seeds.fields, *audit])))
    lk.reset(spark, lake, silver.schema, gd.daily_state(silver).schema)


def as_of_bronze(spark: SparkSession, lake: lk.Lake, ts: dt.datetime) -> DataFrame:
    """Bronze as it stood at ``ts`` (append-only, so a filter on arrival)."""
    lit = F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")
    return (_bronze(spark, lake)
            .filter(F.col("_ingest_date") <= F.lit(ts.date()))
            .filter(F.col("_ingested_at") <= lit))
