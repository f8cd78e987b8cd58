"""Property tests of the drift operator (many batches, Spark joins) and of the staged change set."""

from __future__ import annotations

import ast

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from lakeguard.functions.types import TYPE_ALIASES, normalize_type_name
from lakeguard.operators import drift
from lakeguard.sources import contracts as ct

TYPES = sorted((set(TYPE_ALIASES) | {"integer", "double", "string", "timestamp", "date"})
               - {"str", "bool", "varchar"})
SPARK = {"int": "int", "long": "bigint", "bigint": "bigint", "float": "float",
         "timestamp_ntz": "timestamp_ntz", "integer": "int", "double": "double",
         "string": "string", "timestamp": "timestamp", "date": "date"}
NAMES = ["a", "b", "c", "d", "e", "f"]

schemas = st.lists(st.tuples(st.sampled_from(NAMES), st.sampled_from(TYPES)),
                   min_size=1, max_size=6, unique_by=lambda x: x[0])


def struct(cols):
    return T.StructType([T.StructField(n, T._parse_datatype_string(SPARK[t])) for n, t in cols])


@settings(max_examples=12, deadline=None)
@given(st.lists(schemas, min_size=1, max_size=4), schemas)
def test_verdicts_follow_the_rules(spark, batches, baseline):
    base = struct(baseline)
    incoming = ct.contract_of(spark, {f"b{i}": struct(s) for i, s in enumerate(batches)})
    pairs = spark.createDataFrame([(f"b{i}", "base") for i in range(len(batches))],
                                  "batch_id string, baseline_key string")
    got = {r.batch_id: r.asDict() for r in drift.verdict_text(
        drift.classify(incoming, ct.contract_of(spark, {"base": base}), pairs)).collect()}
    for i, s in enumerate(batches):
        row = got[f"b{i}"]
        have = {f.name: normalize_type_name(f.dataType.simpleString()) for f in struct(s)}
        want = {f.name: normalize_type_name(f.dataType.simpleString()) for f in base}
        changed = {c for c in have.keys() & want.keys() if have[c] != want[c]}
        assert set(ast.literal_eval(row["added_columns"])) == have.keys() - want.keys()
        assert set(ast.literal_eval(row["removed_columns"])) == want.keys() - have.keys()
        assert {t["column"] for t in ast.literal_eval(row["type_changes"])} == changed
        assert (row["verdict"] == drift.BREAKING) == bool(changed or want.keys() - have.keys())


def test_narrow_staged_change_set_merges_like_the_full_width_one(spark):
    """The model runs stage a change set found through narrow target columns
    (keys whose current row stays are left out); merged, it gives the same
    Silver as the full-width arrival / event-time change set."""
    from pyspark.sql import functions as F

    from conftest import SF_SMALL
    from lakeguard.operators.latest import latest_per_key
    from lakeguard.operators.merge import symmetric_difference
    from lakeguard.plans import lake as lk
    from lakeguard.plans import silver as sv
    from lakeguard.sources import fixture as fx

    bronze = fx.bronze_fixture(spark, SF_SMALL)
    # newest versions arrive first, older ones late: the current row often stays
    late = bronze.withColumn("_ingested_at", F.when(
        F.col("updated_at") > fx.ntz(fx.BATCH_SPLIT), fx.ntz(fx.BATCH_INGESTED_AT[1]))
        .otherwise(fx.ntz(fx.BATCH_INGESTED_AT[2])))
    for mode, data, wm, stays in [("arrival", late, fx.ntz(fx.BATCH_INGESTED_AT[1]), True),
                                  ("arrival", bronze, fx.ntz(fx.BATCH_INGESTED_AT[1]), False),
                                  ("event_time", bronze, fx.ntz(fx.BATCH_SPLIT), False)]:
        first = data.filter(F.col("_ingested_at") == fx.ntz(fx.BATCH_INGESTED_AT[1]))
        if mode == "event_time":
            first = data.filter(F.col("updated_at") <= fx.ntz(fx.BATCH_SPLIT))
        target = sv.silver_full(first, fx.FIXTURE_VERSION_ORDER).withColumn(
            "_part", lk.silver_partition())
        delta = data.filter(F.col("updated_at" if mode == "event_time" else "_ingested_at") > wm)
        wide = sv.project(latest_per_key(delta, sv.KEY, fx.FIXTURE_VERSION_ORDER))
        if mode == "arrival":
            rivals = target.join(delta.select(sv.KEY), sv.KEY, "left_semi").select(*sv.SILVER_COLUMNS)
            wide = latest_per_key(wide.unionByName(rivals), sv.KEY, sv.arrival_order(fx.FIXTURE_VERSION_ORDER))
        staged = sv.staged_change_set(data, target, lk.silver_partition(), mode=mode, watermark=wm,
                                      version_order=fx.FIXTURE_VERSION_ORDER)
        new = staged.filter("_side = 'new'").drop("_side", "_part")
        assert symmetric_difference(sv.merge_changes(target, wide),
                                    sv.merge_changes(target, new)).count() == 0, mode
        assert (new.count() < wide.count()) if stays else (new.count() == wide.count())
        old_keys = staged.filter("_side = 'old'").select("order_id")
        assert old_keys.join(target, "order_id", "left_anti").count() == 0
