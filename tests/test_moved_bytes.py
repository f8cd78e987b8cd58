"""What the runs shuffle and write: each step once, and in every call of a query."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakeguard.operators.merge import symmetric_difference
from lakeguard.plans import catalog, silver
from lakeguard.session import local_table
from lakeguard.sources import fixture as fx


class Made(Exception):
    pass


def made(*_, **__):
    raise Made


def shuffles(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("shapes", [None, ["baseline", "non_breaking"]])
def test_replay_joins_the_changelog_once(spark, monkeypatch, shapes):
    read = []
    monkeypatch.setattr(catalog.ig, "ingest", lambda spark, batch, *_, **__: read.append((batch.inputFiles(), batch.count())))
    catalog._replay(spark, SF_SMALL, silver_mode=None, shapes=shapes)
    assert len(read) == 2 and sum(n for _, n in read) == fx.raw_orders(spark, SF_SMALL).count()
    assert not [f for files, _ in read for f in files if SF_SMALL in f]


def test_large_tables_are_written_compressed(spark, lake):
    stamp = dt.datetime(2001, 1, 1)
    batch = local_table(spark, [(str(i), "c", "p", 1, 1.0, "pending", stamp, stamp) for i in range(3)],
                        "order_id string, customer_id string, product_id string, quantity int, unit_price double, "
                        "status string, created_at timestamp_ntz, updated_at timestamp_ntz")
    for n in (1, 2):
        catalog.ig.ingest(spark, batch, lake, batch_id=f"b{n}", ingested_at=dt.datetime(2001, 1, 1 + n))
        run = catalog.models.silver_incremental(spark, lake)
    for path in (lake.bronze, lake.silver, lake.staging(run["run_id"], "changes")):
        names = spark.read.parquet(path).inputFiles()
        assert names and all(".zstd." in f for f in names), names


@pytest.mark.parametrize("name", ["sink_drift_check", "sla_freshness", "sla_completeness"])
def test_checks_make_their_own_lake(spark, monkeypatch, tmp_path, name):
    """Not one that another query, or an earlier call, has left."""
    monkeypatch.setattr(catalog, "_once", lambda *_: str(tmp_path))
    monkeypatch.setattr(catalog, "_replay", made)
    with pytest.raises(Made):
        getattr(catalog, name)(spark, SF_SMALL)


def test_landed_batches_are_written_in_every_call(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(catalog, "_once", lambda *_: str(tmp_path))
    monkeypatch.setattr(fx, "raw_orders", made)
    with pytest.raises(Made):
        catalog.schema_drift_verdict(spark, SF_SMALL)


def test_difference_shuffles_each_side_once_and_counts_copies(spark):
    schema = "k string, v double"
    a = local_table(spark, [("a", 1.0)] * 3 + [("b", 2.0), (None, None), (None, None), ("c", 3.0)], schema)
    b = local_table(spark, [("a", 1.0), ("b", 2.0), (None, None), ("d", 4.0), ("d", 4.0)], schema)
    diff = symmetric_difference(a, b)
    assert diff.columns == ["k", "v", "side"]
    assert shuffles(diff) == 1
    assert Counter(tuple(r) for r in diff.collect()) == {
        ("a", 1.0, "only_first"): 2, (None, None, "only_first"): 1, ("c", 3.0, "only_first"): 1, ("d", 4.0, "only_second"): 2}


ROW = ("order_id string, customer_id string, product_id string, quantity int, unit_price double, status string, "
       "created_at timestamp_ntz, updated_at timestamp_ntz, _ingested_at timestamp_ntz, _schema_version string, _source string")


@pytest.mark.parametrize("mode", ["arrival", "event_time"])
def test_change_set_deals_out_every_side_once(spark, tmp_path, mode):
    def row(key, status, day):
        at = dt.datetime(2001, 1, day)
        return (key, "c", "p", 2, 1.5, status, dt.datetime(2000, 1, 1), at, at, "v1", "s")

    part = F.lit(200001)
    local_table(spark, [row("a", "pending", 1), row(None, "pending", 1), row("b", "pending", 1)], ROW).write.parquet(f"{tmp_path}/1")
    local_table(spark, [row("a", "shipped", 2), row("a", "delivered", 3), row(None, "shipped", 2), row("n", "pending", 2)],
                ROW).write.parquet(f"{tmp_path}/2")
    silver.silver_full(spark.read.parquet(f"{tmp_path}/1")).withColumn("_part", part).write.parquet(f"{tmp_path}/t")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stage = silver.staged_change_set(spark.read.parquet(f"{tmp_path}/2"), spark.read.parquet(f"{tmp_path}/t"), part, mode=mode)
        assert shuffles(stage) == 3  # the delta's versions, its keys, the target
        found = {(r["order_id"], r["_side"], r["status"], r["line_total"]) for r in stage.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert found == {("a", "new", "delivered", 3.0), ("a", "old", "pending", 3.0), (None, "new", "shipped", 3.0),
                     (None, "old", "pending", 3.0), ("n", "new", "pending", 3.0)}
    assert stage.columns == [*silver.SILVER_COLUMNS, "_part", "_side"]
