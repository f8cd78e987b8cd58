"""Bronze's data tests kept up by batch equal those over the whole table."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from lakeguard.operators import quality
from lakeguard.plans import ingest as ig
from lakeguard.plans import key_counts as kc
from lakeguard.plans import lake as lk
from lakeguard.plans import models, pipeline
from test_recovery import COLUMNS, DriverLost, driver_dies

ROWS = ["c", "p", 1, 10.0, "delivered", dt.datetime(2001, 1, 1), dt.datetime(2001, 1, 2)]


def batch(spark, keys, rnd):
    """Rows of these keys, with some other columns null."""
    rows = [(k, *[None if rnd.random() < 0.2 else v for v in ROWS]) for k in keys]
    return spark.createDataFrame(rows, COLUMNS)


def by_test(rows):
    return {(r.column_name, r.test): (r.failures, r.status) for r in rows.collect()}


def assert_same(spark, lake):
    whole = quality.report([quality.declared("bronze.raw_orders", models._bronze(spark, lake))])
    assert by_test(kc.report(spark, lake)) == by_test(whole)


def test_random_batches_and_replays(spark, lake):
    rnd = random.Random(3)
    keys = [None, *(f"k{i}" for i in range(12))]
    for step, name in enumerate(["a", "b/2001-01-01T10:00", "c", "a", "c"]):  # some are delivered again
        made = batch(spark, rnd.choices(keys, k=rnd.randint(1, 8)), rnd)
        ig.ingest(spark, made, lake, batch_id=name, ingested_at=dt.datetime(2001, 12, 1 + step))
        if step != 1:                                    # then two writes are taken at once
            assert kc.update(spark, lake) > 0
            assert_same(spark, lake)
    assert kc.update(spark, lake) == 0
    assert_same(spark, lake)


def test_one_batch_written_twice_before_a_run(spark, lake):
    rnd = random.Random(4)
    for keys in (["k", "k", "j"], ["k", "j"]):
        ig.ingest(spark, batch(spark, keys, rnd), lake, batch_id="a")
    assert kc.update(spark, lake) == 1
    assert_same(spark, lake)


def test_batches_taken_before_are_not_read(spark, lake):
    rnd = random.Random(5)
    ig.ingest(spark, batch(spark, ["k", "j"], rnd), lake, batch_id="a", ingested_at=dt.datetime(2001, 12, 1))
    kc.update(spark, lake)
    lk.delete_path(spark, f"{lake.bronze}/_ingest_date=2001-12-01")
    ig.ingest(spark, batch(spark, ["k", "i"], rnd), lake, batch_id="b", ingested_at=dt.datetime(2001, 12, 2))
    kc.update(spark, lake)
    assert by_test(kc.report(spark, lake))[("order_id", "unique")] == (1, "FAIL")


@pytest.mark.parametrize("step, lose", [(1, False), (2, False), (3, False), (3, True)])
def test_interrupted_runs_count_nothing_twice(spark, lake, monkeypatch, step, lose):
    """Before the plan is logged, before the overwrite, before the commit, and with a partition half swapped in."""
    rnd = random.Random(6)
    ig.ingest(spark, batch(spark, ["k", "j", "j"], rnd), lake, batch_id="a")
    kc.update(spark, lake)
    ig.ingest(spark, batch(spark, ["k", "i", None], rnd), lake, batch_id="b")
    ig.ingest(spark, batch(spark, ["k", "j"], rnd), lake, batch_id="a")
    with monkeypatch.context() as m:
        driver_dies(m, step)
        with pytest.raises(DriverLost):
            kc.update(spark, lake)
    if lose:
        lk.delete_path(spark, f"{lake.bronze_keys}/_batch_id=a")
    kc.update(spark, lake)
    assert_same(spark, lake)
    assert kc.update(spark, lake) == 0


def test_empty_batch_and_reset(spark, lake):
    rnd = random.Random(7)
    ig.ingest(spark, batch(spark, ["k", "k"], rnd), lake, batch_id="a")
    ig.ingest(spark, batch(spark, ["k"], rnd).limit(0), lake, batch_id="empty")
    rows = by_test(pipeline.run_data_tests(spark, lake))
    assert rows[("order_id", "unique")] == (1, "FAIL")
    assert_same(spark, lake)
    models.reset(spark, lake)
    assert not lk.exists(spark, lake.bronze_keys) and lk.read_log(spark, lake, "data_test_log").count() == 0
    ig.ingest(spark, batch(spark, ["k"], rnd), lake, batch_id="a")
    kc.update(spark, lake)
    assert_same(spark, lake)
