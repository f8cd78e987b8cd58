"""SLA boundaries, data tests and cost arithmetic."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeguard.operators import cost, quality, sla
from lakeguard.sources import contracts as ct

ROWS = "updated_at timestamp_ntz, _ingested_at timestamp_ntz"


def bronze(spark, latest="2001-11-04 00:00:00", n_today=100, day="2001-12-02"):
    base = spark.createDataFrame([(latest, f"{day} 03:00:00")], "u string, i string")
    many = base.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(n_today))))
    return many.select(F.col("u").cast("timestamp_ntz").alias("updated_at"),
                       F.col("i").cast("timestamp_ntz").alias("_ingested_at"))


def status(df, name):
    return {r.check_name: (r.status, r.detail) for r in df.collect()}[name]


def test_freshness_boundary(spark):
    b = bronze(spark)
    for as_of, expect in [("2001-11-04 06:00:00", "PASS"), ("2001-11-04 06:00:01", "FAIL")]:
        at = sla.ts_literal(as_of)
        st, detail = status(sla.freshness(sla.metrics(b, at), at, 6), "freshness")
        assert st == expect
    assert detail == "Data is 6.0h old, threshold=6h"


def test_freshness_empty_and_future(spark):
    empty = spark.createDataFrame([], ROWS)
    at = sla.ts_literal("2001-11-04 06:00:00")
    assert status(sla.freshness(sla.metrics(empty, at), at, 6), "freshness") == \
        ("FAIL", "No data in Bronze table")
    st, detail = status(sla.freshness(sla.metrics(bronze(spark), sla.ts_literal("2001-11-03 22:00:00")),
                                      sla.ts_literal("2001-11-03 22:00:00"), 6), "freshness")
    assert st == "PASS" and "future" in detail


def test_completeness_boundary(spark):
    at = sla.ts_literal("2001-12-02 12:00:00")
    assert status(sla.completeness(sla.metrics(bronze(spark, n_today=100), at), 100),
                  "completeness") == ("PASS", "")
    assert status(sla.completeness(sla.metrics(bronze(spark, n_today=99), at), 100),
                  "completeness") == ("FAIL", "Row count 99 below minimum 100")


def test_suite_reports_every_rule_with_impact_and_skips_unknown(spark):
    rules = [r.asDict() for r in sla.load_rules(spark).collect()]
    rules.append({"check_name": "volume", "business_impact": "x"})
    live = ct.seed_contracts(spark, ["v1"])
    out = sla.run_checks(spark, bronze(spark), "2001-12-02 06:00:00", live, live, rules).collect()
    assert sorted(r.check_name for r in out) == ["completeness", "freshness", "schema_consistency"]
    assert all(r.business_impact for r in out)
    none = sla.run_checks(spark, bronze(spark), "2001-12-02 06:00:00", rules=[])
    assert none.count() == 0 and "business_impact" in none.columns


def test_freshness_and_completeness_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "b")
    bronze(spark).write.parquet(path)
    b = spark.read.parquet(path)
    live = ct.seed_contracts(spark, ["v1"])
    df = sla.run_checks(spark, b, "2001-12-02 06:00:00", live, live)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Scan parquet") == 1, final


def test_completeness_on_partitioned_bronze_reads_no_ingest_column(spark, tmp_path):
    """On the lake table the ingest day is the _ingest_date partition value:
    the SLA pass reads updated_at only, and counts agree with to_date(_ingested_at)."""
    path = str(tmp_path / "b")
    days = bronze(spark, n_today=100).unionByName(bronze(spark, n_today=99, day="2001-12-03"))
    days.withColumn("_ingest_date", F.to_date("_ingested_at")) \
        .write.partitionBy("_ingest_date").parquet(path)
    b = spark.read.parquet(path)
    instants = ["2001-12-02 06:00:00", "2001-12-03 06:00:00", "2001-12-04 06:00:00"]
    df = sla.run_checks(spark, b, instants,
                        rules=[{"check_name": "completeness", "min_rows_per_run": 100,
                                "business_impact": "x"},
                               {"check_name": "freshness", "threshold_hours": 6,
                                "business_impact": "y"}])
    got = {str(r.checked_at.date()): r.status for r in df.collect()
           if r.check_name == "completeness"}
    assert got == {"2001-12-02": "PASS", "2001-12-03": "FAIL", "2001-12-04": "FAIL"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<updated_at:timestamp_ntz>" in plan, plan


def test_data_tests_one_row_per_declared_test(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2)], "k string, v int")
    rep = quality.report([quality.TableTests("t", df, ["k", "v"], ["k"])])
    got = {(r.column_name, r.test): (r.failures, r.status) for r in rep.collect()}
    assert got == {("k", "not_null"): (1, "FAIL"), ("v", "not_null"): (1, "FAIL"),
                   ("k", "unique"): (1, "FAIL")}
    assert sum(len(v["not_null"]) + len(v["unique"]) for v in quality.DECLARED.values()) == 30


def test_cost_golden_values(spark):
    runs = spark.createDataFrame([("p", "full_refresh", 42.0), ("p", "incremental", 8.0)],
                                 "pipeline_name string, run_type string, runtime_seconds double")
    c = {r.run_type: r for r in cost.with_cost(runs).collect()}
    assert c["full_refresh"].estimated_dbu == pytest.approx(0.023333, abs=1e-9)
    assert c["full_refresh"].estimated_cost_usd == pytest.approx(0.005133, abs=1e-9)
    assert c["incremental"].estimated_dbu == pytest.approx(0.004444, abs=1e-9)
    s = cost.savings(cost.project_costs(runs)).first()
    assert s.full_refresh_usd == pytest.approx(0.616, abs=1e-9)
    assert s.incremental_usd == pytest.approx(0.117333333, abs=1e-8)
    assert s.savings_usd == pytest.approx(0.498666667, abs=1e-8)
    proj = cost.project_costs(runs).filter("run_type = 'full_refresh'").orderBy("day").collect()
    assert len(proj) == 30 and proj[0].cumulative_cost_usd == pytest.approx(0.0205333, abs=1e-7)
    ratio = cost.full_vs_incremental(runs).first().ratio
    assert ratio == pytest.approx(5.25)


def test_costs_follow_the_logged_runs(spark):
    """Other runtimes in the log, other projections, ratios and sums."""
    def log(full, incremental):
        rows = [("p", "full_refresh", s, 1, dt.datetime(2001, 12, d)) for d, s in full]
        rows += [("p", "incremental", s, 1, dt.datetime(2001, 12, d)) for d, s in incremental]
        return cost.with_cost(spark.createDataFrame(
            rows, "pipeline_name string, run_type string, runtime_seconds double, rows_processed long, logged_at timestamp_ntz"))

    one = log([(1, 30.0), (2, 50.0)], [(1, 10.0), (1, 30.0), (3, 20.0)])
    assert {r.run_type: r.runtime_seconds for r in cost.mean_runtimes(one).collect()} == {"full_refresh": 40.0, "incremental": 20.0}
    assert cost.full_vs_incremental(one).first().ratio == 2.0
    spent = {(r.run_type, r.day.day): (r.runs, r.cumulative_cost_usd) for r in cost.spent_by_day(one).collect()}
    usd = lambda s: round(s / 3600 * cost.DBU_PER_HOUR * cost.DBU_RATE_USD, 6)
    assert spent[("incremental", 1)] == (2, pytest.approx(usd(10) + usd(30)))
    assert spent[("incremental", 3)] == (1, pytest.approx(usd(10) + usd(30) + usd(20)))
    slower = cost.savings(cost.project_costs(cost.mean_runtimes(log([(1, 400.0)], [(1, 20.0)])))).first()
    assert slower.savings_usd > cost.savings(cost.project_costs(cost.mean_runtimes(one))).first().savings_usd


def test_batch_log_gives_what_the_rows_give(spark):
    """V1/V2 from what ingests observed equal the scan; a batch written again counts once."""
    at = [sla.ts_literal(f"2001-12-0{d} 12:00:00") for d in (1, 2, 3)]
    day = lambda d, h=0: dt.datetime(2001, 12, d, h)
    log = spark.createDataFrame(
        [("s1", "a", day(1), 7, day(1), day(1, 1)), ("s2", "b", day(2), 5, day(2), day(2, 1)),
         ("s3", "a", day(1), 9, day(1, 5), day(2, 2)), ("s4", "c", day(2), 0, None, day(2, 3))],
        "source_id string, batch_id string, ingested_at timestamp_ntz, rows long, latest_updated_at timestamp_ntz, logged_at timestamp_ntz")
    rows = spark.createDataFrame([(day(1, 5), day(1))] * 9 + [(day(2), day(2))] * 5, ROWS)
    assert sla.metrics(sla.of_batches(log), at).first() == sla.metrics(rows, at).first()
    assert sla.metrics(sla.of_batches(log.limit(0)), at).first() == sla.metrics(rows.limit(0), at).first()


def test_a_table_s_suite_is_one_scan_and_one_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("a", 1), ("a", None), (None, 2), (None, 3), ("b", 4)]
    spark.createDataFrame(rows, "k string, v int").write.parquet(path)
    report = quality.report([quality.TableTests("t", spark.read.parquet(path), ["k", "v"], ["k"])])
    got = {(r.column_name, r.test): r.failures for r in report.collect()}
    assert got == {("k", "not_null"): 2, ("v", "not_null"): 1, ("k", "unique"): 1}
    final = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Scan parquet") == 1 and final.count("Exchange hashpartitioning") == 1
    empty = quality.report([quality.TableTests("t", spark.read.parquet(path).limit(0), ["k", "v"], ["k"])])
    assert {r.failures for r in empty.collect()} == {0}
