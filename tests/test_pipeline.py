"""Guarded ingest, model runs and the landing stream, end to end on Parquet."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakeguard.operators import merge as mg
from lakeguard.plans import gold as gd
from lakeguard.plans import lake as lk
from lakeguard.plans import models
from lakeguard.plans import silver as sv
from lakeguard.plans.ingest import SchemaBreakingChangeError, ingest
from lakeguard.sources import fixture as fx
from lakeguard.sources import scenarios as sc

T1, T2, T3, T4 = (dt.datetime(2001, 12, d) for d in (1, 2, 3, 4))


def listing(path):
    out = []
    for root, _, files in os.walk(path):
        out += [os.path.join(root, f) for f in files]
    return sorted(out)


@pytest.fixture(scope="module")
def batches(spark):
    shapes = sc.scenario_batches(spark, SF_SMALL)
    split = F.col("updated_at") <= fx.ntz(fx.BATCH_SPLIT)
    return {
        "v1_old": shapes["baseline"].filter(split),
        "v1_new": shapes["baseline"].filter(~split),
        "v2_new": shapes["non_breaking"].filter(~split),
        "v3": shapes["breaking"],
        "all": shapes["baseline"],
    }


def test_ingest_enriches_counts_and_logs(spark, lake, batches):
    n = ingest(spark, batches["v1_old"], lake, batch_id="b1", ingested_at=T1, evaluated_at=T1)
    bronze = spark.read.parquet(lake.bronze)
    assert n == batches["v1_old"].count() == bronze.count()
    # one _ingested_at value for the whole run, audit columns present
    assert bronze.select("_ingested_at", "_schema_version", "_source").distinct().count() == 1
    log = lk.read_log(spark, lake, "schema_change_log").collect()
    assert [(r.verdict, r.baseline) for r in log] == [("NON_BREAKING", "schema_v1.json")]
    costs = lk.read_log(spark, lake, "cost_attribution_log").collect()
    assert len(costs) == 1 and costs[0].rows_processed == n and costs[0].estimated_dbu >= 0


def test_breaking_batch_halts_before_any_write(spark, lake, batches):
    ingest(spark, batches["v1_old"], lake, batch_id="b1", ingested_at=T1)
    before = listing(lake.bronze)
    with pytest.raises(SchemaBreakingChangeError):
        ingest(spark, batches["v3"], lake, batch_id="b3", ingested_at=T2)
    assert listing(lake.bronze) == before  # Bronze byte-identical
    inc = lk.read_log(spark, lake, "incident_log").collect()
    assert len(inc) == 1 and inc[0].event == "PIPELINE_HALTED"
    assert inc[0].removed_columns == "['customer_id']"
    assert len(lk.read_log(spark, lake, "cost_attribution_log").collect()) == 1


def test_four_run_scenario_live_contract(spark, lake, batches):
    """v1 -> v2 -> v3 -> v1: the accepted v2 column becomes required."""
    ingest(spark, batches["v1_old"], lake, batch_id="r1", ingested_at=T1, evaluated_at=T1)
    ingest(spark, batches["v2_new"], lake, batch_id="r2", schema_version="v2", ingested_at=T2,
           evaluated_at=T2)
    with pytest.raises(SchemaBreakingChangeError):
        ingest(spark, batches["v3"], lake, batch_id="r3", evaluated_at=T3)
    with pytest.raises(SchemaBreakingChangeError):
        ingest(spark, batches["v1_old"], lake, batch_id="r4", evaluated_at=T4)
    changes = {r.batch_id: r.added_columns for r in lk.read_log(spark, lake, "schema_change_log").collect()}
    assert changes == {"r1": "[]", "r2": "['delivery_partner']"}
    inc = {r.batch_id: r.removed_columns for r in lk.read_log(spark, lake, "incident_log").collect()}
    assert inc == {"r3": "['customer_id', 'delivery_partner']", "r4": "['delivery_partner']"}
    bronze = spark.read.option("mergeSchema", True).parquet(lake.bronze)
    # evolved read: the older batch reads the new column as null
    assert bronze.filter(F.col("_schema_version") == "v1").filter(
        F.col("delivery_partner").isNotNull()).count() == 0


def test_bigint_batch_is_cast_to_table_type(spark, lake, batches):
    ingest(spark, batches["v1_old"], lake, batch_id="a", ingested_at=T1)
    wide = batches["v1_new"].withColumn("quantity", F.col("quantity").cast("bigint"))
    ingest(spark, wide, lake, batch_id="b", ingested_at=T2)
    bronze = spark.read.option("mergeSchema", True).parquet(lake.bronze)
    assert dict(bronze.dtypes)["quantity"] == "int"
    assert bronze.count() == batches["all"].count()


def _silver_equals_full(spark, lake):
    silver = models.silver_table(spark, lake)
    full = sv.silver_full(spark.read.option("mergeSchema", True).parquet(lake.bronze))
    assert mg.symmetric_difference(silver, full).count() == 0
    assert silver.groupBy("order_id").count().filter("count > 1").count() == 0
    return silver


@pytest.mark.parametrize("mode", ["event_time", "arrival"])
def test_incremental_equals_full_refresh(spark, lake, batches, mode):
    ingest(spark, batches["v1_old"], lake, batch_id="b1", ingested_at=T1)
    models.silver_incremental(spark, lake, mode=mode)
    models.gold_incremental(spark, lake)
    ingest(spark, batches["v1_new"], lake, batch_id="b2", ingested_at=T2)
    models.silver_incremental(spark, lake, mode=mode)
    models.gold_incremental(spark, lake, mode="touched_dates")
    silver = _silver_equals_full(spark, lake)
    assert mg.symmetric_difference(models.gold_table(spark, lake), gd.daily_revenue(silver, True)).count() == 0


def test_observed_run_summary_matches_the_staged_table(spark, lake, batches):
    """Row count, touched partitions and watermark of a run are observed on
    its staging write; they equal a recount of what was staged."""
    ingest(spark, batches["v1_old"], lake, batch_id="b1", ingested_at=T1)
    models.silver_incremental(spark, lake, mode="arrival")
    ingest(spark, batches["v1_new"], lake, batch_id="b2", ingested_at=T2)
    run = models.silver_incremental(spark, lake, mode="arrival")
    staged = spark.read.parquet(lake.staging(run["run_id"], "changes"))
    new = staged.filter("_side = 'new'")
    assert run["rows"] == new.count() > 0
    parts = sorted(r[0] for r in staged.select("_part").distinct().collect() if r[0] is not None)
    assert run["touched_months"] == parts and run["partitions"] == len(parts)
    last = lk.read_log(spark, lake, "run_log").filter(
        f"run_id = '{run['run_id']}' and status = 'committed'").first()
    assert last.rows == run["rows"]
    assert last.watermark_ingested_at == T2


def test_gold_latest_date_run_follows_the_reference_rule(spark, lake, batches):
    """latest_date mode: dates from Gold's latest date on are re-aggregated
    from Silver and replace their rows; older dates keep their values."""
    ingest(spark, batches["v1_old"], lake, batch_id="b1", ingested_at=T1)
    models.silver_incremental(spark, lake, mode="arrival")
    models.gold_incremental(spark, lake)
    gold1 = models.gold_table(spark, lake)
    gold1 = spark.createDataFrame(gold1.collect(), gold1.schema)  # keep run 1's rows
    wm = gold1.agg(F.max("order_date")).first()[0]
    ingest(spark, batches["v1_new"], lake, batch_id="b2", ingested_at=T2)
    models.silver_incremental(spark, lake, mode="arrival")
    models.gold_incremental(spark, lake, mode="latest_date")
    silver = spark.read.parquet(lake.silver).drop("_part")
    expected = gd.merge_gold(gold1, gd.daily_revenue(gd.gold_delta(silver, F.lit(wm)), True))
    got = models.gold_table(spark, lake)
    assert mg.symmetric_difference(got, expected).count() == 0
    assert got.count() == got.select("order_date").distinct().count()


def test_merge_twice_is_merge_once(spark, lake, batches):
    ingest(spark, batches["v1_old"], lake, batch_id="b1", ingested_at=T1)
    models.silver_incremental(spark, lake, mode="arrival")
    ingest(spark, batches["v1_new"], lake, batch_id="b2", ingested_at=T2)
    models.silver_incremental(spark, lake, mode="arrival")
    snapshot = [tuple(r) for r in spark.read.parquet(lake.silver).orderBy("order_id").collect()]
    again = models.silver_incremental(spark, lake, mode="arrival")
    assert again["rows"] == 0
    assert [tuple(r) for r in spark.read.parquet(lake.silver).orderBy("order_id").collect()] == snapshot


def test_arrival_mode_is_order_independent(spark, tmp_path, batches):
    """Batches arriving newest-first give the same Silver in arrival mode,
    while the event-time rule drops the late older versions."""
    results = {}
    for mode in ("arrival", "event_time"):
        lake = lk.Lake(str(tmp_path / mode))
        ingest(spark, batches["v1_new"], lake, batch_id="new", ingested_at=T1)
        models.silver_incremental(spark, lake, mode=mode)
        ingest(spark, batches["v1_old"], lake, batch_id="old", ingested_at=T2)
        models.silver_incremental(spark, lake, mode=mode)
        results[mode] = spark.read.parquet(lake.silver).drop("_part")
    full = sv.silver_full(batches["all"].withColumns({
        "_ingested_at": F.lit(None).cast("timestamp_ntz"), "_schema_version": F.lit("v1"),
        "_source": F.lit(fx.PIPELINE_ID)}))
    key = lambda d: d.select("order_id", "updated_at", "status", "product_id")
    assert mg.symmetric_difference(key(results["arrival"]), key(full)).count() == 0
    assert results["event_time"].count() < full.count()


def test_empty_target_null_watermark_selects_everything(spark):
    b = fx.bronze_fixture(spark, SF_SMALL)
    empty = spark.createDataFrame([], sv.project(b).schema)
    from lakeguard.operators.watermark import watermark_value
    assert sv.silver_delta(b, watermark_value(empty, "updated_at")).count() == b.count()
    assert sv.silver_delta(b, None).count() == b.count()


def test_reset_drops_bronze_and_empties_the_rest(spark, lake, batches):
    ingest(spark, batches["v1_old"], lake, batch_id="b1", ingested_at=T1)
    models.silver_incremental(spark, lake)
    models.gold_incremental(spark, lake)
    before = models.silver_table(spark, lake).schema, models.gold_table(spark, lake).schema
    models.reset(spark, lake)
    assert not lk.exists(spark, lake.bronze)
    for table, schema in zip((models.silver_table, models.gold_table), before):   # empty, with their schemas
        assert table(spark, lake).count() == 0
        assert [(f.name, f.dataType) for f in table(spark, lake).schema] == [(f.name, f.dataType) for f in schema]
    assert all(lk.read_log(spark, lake, name).count() == 0 for name in lk.LOG_SCHEMAS)
    # next run seeds from v1 again, and the tables are built anew
    ingest(spark, batches["v1_new"], lake, batch_id="b2", ingested_at=T2)
    assert lk.read_log(spark, lake, "schema_change_log").first().baseline == "schema_v1.json"
    models.silver_incremental(spark, lake)
    models.gold_incremental(spark, lake)
    silver = _silver_equals_full(spark, lake)
    assert mg.symmetric_difference(models.gold_table(spark, lake), gd.daily_revenue(silver, True)).count() == 0


def test_landing_stream_halts_and_replays(spark, tmp_path, batches):
    from lakeguard.streaming import landing
    land, lake = str(tmp_path / "in"), lk.Lake(str(tmp_path / "lake"))
    ckpt = str(tmp_path / "ckpt")
    landing.drop_batch(batches["v1_old"], land, "b1")
    landing.drop_batch(batches["v3"], land, "b2")
    q = landing.start(spark, land, lake, ckpt, clock=lambda: T1)
    with pytest.raises(Exception):
        q.awaitTermination()
    assert spark.read.parquet(lake.bronze).count() == batches["v1_old"].count()
    assert lk.read_log(spark, lake, "incident_log").first().batch_id == "b2"
    assert os.path.isdir(os.path.join(land, "b2"))  # halted files stay, replayable
    # restart: the same micro-batch is replayed; b1 is skipped, b2 halts again
    q = landing.start(spark, land, lake, ckpt, clock=lambda: T2)
    with pytest.raises(Exception):
        q.awaitTermination()
    assert spark.read.parquet(lake.bronze).count() == batches["v1_old"].count()
    assert lk.read_log(spark, lake, "incident_log").count() == 2


def test_pipeline_three_scenarios(spark, lake, batches):
    """baseline -> non-breaking -> breaking: the last run halts at ingest and
    skips models and SLA; SLA rows are written pass or fail."""
    from lakeguard.plans import pipeline
    s1 = {r.stage: r.status for r in pipeline.run(
        spark, lake, batches["v1_old"], batch_id="p1", ingested_at=T1, as_of=T1).collect()}
    assert s1 == {"ingest_bronze": "SUCCESS", "silver": "SUCCESS", "gold": "SUCCESS",
                  "sla_check": "SUCCESS"}
    pipeline.run(spark, lake, batches["v2_new"], batch_id="p2", schema_version="v2",
                 ingested_at=T2, as_of=T2)
    before = listing(lake.bronze)
    s3 = {r.stage: r.status for r in pipeline.run(
        spark, lake, batches["v3"], batch_id="p3", ingested_at=T3, as_of=T3).collect()}
    assert s3 == {"ingest_bronze": "FAILED", "silver": "SKIPPED", "gold": "SKIPPED",
                  "sla_check": "SKIPPED"}
    assert listing(lake.bronze) == before
    sla_log = lk.read_log(spark, lake, "sla_check_log").collect()
    assert len(sla_log) == 6 and all(r.business_impact for r in sla_log)
    costs = {r.run_type for r in lk.read_log(spark, lake, "cost_attribution_log").collect()}
    assert costs == {"full_refresh", "incremental"}  # the first model run built its tables
    _silver_equals_full(spark, lake)
    report = {(r.table_name, r.column_name, r.test): r.status
              for r in pipeline.run_data_tests(spark, lake).collect()}
    assert report[("silver.orders_cleaned", "order_id", "unique")] == "PASS"
    assert report[("bronze.raw_orders", "order_id", "unique")] == "FAIL"  # versions, reported only


def test_log_compaction_keeps_rows_and_lets_writers_go_on(spark, lake, monkeypatch):
    for i in range(6):
        lk.append_log(spark, lake, "sla_check_log",
                      [("freshness", "PASS", "x" * 500, "impact", dt.datetime(2001, 12, 1, i))] * 40)

    def files():
        return [f for f in listing(lake.log("sla_check_log")) if f.endswith(".parquet")]

    def hours():
        return sorted(r.checked_at.hour for r in lk.read_log(spark, lake, "sla_check_log").collect())

    expected = sorted(list(range(6)) * 40)
    assert len(files()) == 6 and lk.compact_log(spark, lake, "sla_check_log") == {}  # today is open
    size = sum(os.path.getsize(f) for f in files())
    with monkeypatch.context() as m:      # the call dies after staging, before it deletes what it staged
        m.setattr(lk, "delete_path", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            lk.compact_log(spark, lake, "sla_check_log", target_bytes=-(-size // 3), before=99999999)
    lk.compact_log(spark, lake, "sla_check_log", target_bytes=-(-size // 3), before=99999999)
    assert hours() == expected and len(files()) == 3
    lk.append_log(spark, lake, "sla_check_log", [("freshness", "PASS", "", "impact", dt.datetime(2001, 12, 1, 9))])
    assert hours() == expected + [9]
    assert len(lk.compact_log(spark, lake, "sla_check_log", before=99999999)) == 1 and len(files()) == 1
    assert hours() == expected + [9]


def test_landing_stream_refreshes_models(spark, tmp_path, batches):
    from lakeguard.streaming import landing
    land, lake = str(tmp_path / "in"), lk.Lake(str(tmp_path / "lake"))
    landing.drop_batch(batches["v1_old"], land, "b1")
    landing.drop_batch(batches["v2_new"], land, "b2")
    q = landing.start(spark, land, lake, str(tmp_path / "ckpt"), clock=lambda: T1,
                      then=landing.refresh_models)
    q.awaitTermination()
    silver = _silver_equals_full(spark, lake)
    g = models.gold_table(spark, lake)
    assert mg.symmetric_difference(g, gd.daily_revenue(silver, True)).count() == 0


def test_landing_waits_for_complete_batches(spark, tmp_path, batches):
    """A batch still being written (no completion marker) is not read; once
    marked complete, the next trigger ingests all of it."""
    from lakeguard.streaming import landing
    land, lake = str(tmp_path / "in"), lk.Lake(str(tmp_path / "lake"))
    ckpt = str(tmp_path / "ckpt")
    landing.drop_batch(batches["v1_old"], land, "b1")
    batches["v1_new"].write.parquet(f"{land}/b2")  # data written, not yet marked
    landing.start(spark, land, lake, ckpt, clock=lambda: T1).awaitTermination()
    assert spark.read.parquet(lake.bronze).count() == batches["v1_old"].count()
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(f"{land}/b2/{landing.READY}")
    out = marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(marker, False)
    out.write(bytearray(b"b2\n"))
    out.close()
    landing.start(spark, land, lake, ckpt, clock=lambda: T2).awaitTermination()
    assert spark.read.parquet(lake.bronze).count() == batches["all"].count()


def _orders(spark, rows):
    cols = ("order_id string, customer_id string, product_id string, quantity int, unit_price double, "
            "status string, created_at timestamp_ntz, updated_at timestamp_ntz")
    return spark.createDataFrame([(k, "c", "p", 1, 10.0, "delivered", c, u) for k, c, u in rows], cols)


def test_moved_created_month_leaves_no_second_row(spark, lake):
    """An order whose created month changes leaves its old partition, even when that becomes empty."""
    day = lambda m, d=1: dt.datetime(2001, m, d)
    ingest(spark, _orders(spark, [("k1", day(1), day(1)), ("k2", day(3), day(3))]), lake, batch_id="a", ingested_at=T1)
    models.silver_incremental(spark, lake)
    ingest(spark, _orders(spark, [("k1", day(3), day(4))]), lake, batch_id="b", ingested_at=T2)
    models.silver_incremental(spark, lake)
    rows = spark.read.parquet(lake.silver).select("order_id", "created_at").collect()
    assert sorted((r.order_id, r.created_at.month) for r in rows) == [("k1", 3), ("k2", 3)]


def test_row_without_created_at_reaches_silver(spark, lake):
    day = lambda m, d=1: dt.datetime(2001, m, d)
    ingest(spark, _orders(spark, [("k1", day(1), day(1))]), lake, batch_id="a", ingested_at=T1)
    models.silver_incremental(spark, lake)
    ingest(spark, _orders(spark, [("k2", None, day(2)), ("k3", day(2), day(2))]), lake, batch_id="b", ingested_at=T2)
    models.silver_incremental(spark, lake)
    assert sorted(r.order_id for r in spark.read.parquet(lake.silver).collect()) == ["k1", "k2", "k3"]
