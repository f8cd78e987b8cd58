"""Contract gate: type aliases, the documented scenarios, renames, order."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeguard.functions.types import TYPE_ALIASES, normalize_type, normalize_type_name
from lakeguard.operators import drift
from lakeguard.sources import contracts as ct


def verdict_of(spark, incoming: dict, baseline_version="v1", baseline_schema=None):
    batch_schema = T.StructType([T.StructField(k, T._parse_datatype_string(v)) for k, v in incoming.items()])
    inc = ct.contract_of(spark, {"b": batch_schema})
    if baseline_schema is None:
        base = ct.seed_contracts(spark, [baseline_version]).withColumn("contract_key", F.lit("base"))
    else:
        base = ct.contract_of(spark, {"base": baseline_schema})
    pairs = spark.createDataFrame([("b", "base")], "batch_id string, baseline_key string")
    row = drift.classify(inc, base, pairs).first()
    return row


V1 = {"order_id": "string", "customer_id": "string", "product_id": "string", "quantity": "int",
      "unit_price": "double", "status": "string", "created_at": "timestamp", "updated_at": "timestamp"}


def test_alias_table_every_pair(spark):
    names = list(TYPE_ALIASES) + ["INTEGER", "Double", "string", "date", "varchar(10)", "array<int>"]
    df = spark.createDataFrame([(n,) for n in names], "t string")
    got = {r[0]: r[1] for r in df.select("t", normalize_type("t")).collect()}
    for alias, canon in TYPE_ALIASES.items():
        assert got[alias] == canon
    assert got["INTEGER"] == "integer" and got["Double"] == "double"
    # exact lookup only: parametrised and nested names stay verbatim
    assert got["varchar(10)"] == "varchar(10)" and got["array<int>"] == "array<int>"
    assert normalize_type_name("array<int>", deep=True) == "array<integer>"
    assert normalize_type_name("struct<int:bigint>", deep=True) == "struct<int:integer>"


def test_baseline_is_non_breaking_with_empty_lists(spark):
    r = verdict_of(spark, V1)
    assert r.verdict == "NON_BREAKING"
    assert r.added == [] and r.removed == [] and r.type_changes == [] and r.affected_pipelines == []


def test_added_column_is_non_breaking(spark):
    r = verdict_of(spark, {**V1, "delivery_partner": "string"})
    assert r.verdict == "NON_BREAKING" and r.added == ["delivery_partner"] and r.removed == []


def test_removed_column_is_breaking_and_names_blast_radius(spark):
    inc = {k: v for k, v in V1.items() if k != "customer_id"}
    r = verdict_of(spark, inc)
    assert r.verdict == "BREAKING" and r.removed == ["customer_id"]
    assert r.affected_pipelines == drift.DOWNSTREAM


def test_type_change_is_breaking(spark):
    r = verdict_of(spark, {**V1, "quantity": "string"})
    assert r.verdict == "BREAKING"
    assert [tuple(x) for x in r.type_changes] == [("quantity", "integer", "string")]


def test_alias_only_differences_are_non_breaking(spark):
    r = verdict_of(spark, {**V1, "quantity": "bigint", "created_at": "timestamp_ntz"})
    assert r.verdict == "NON_BREAKING" and r.type_changes == []


def test_rename_is_removed_plus_added_and_case_sensitive(spark):
    inc = {("cust_id" if k == "customer_id" else k): v for k, v in V1.items()}
    r = verdict_of(spark, inc)
    assert (r.verdict, r.added, r.removed) == ("BREAKING", ["cust_id"], ["customer_id"])
    inc = {("Customer_ID" if k == "customer_id" else k): v for k, v in V1.items()}
    r = verdict_of(spark, inc)
    assert r.removed == ["customer_id"] and r.added == ["Customer_ID"]


def test_column_order_is_ignored(spark):
    r = verdict_of(spark, dict(reversed(list(V1.items()))))
    assert r.verdict == "NON_BREAKING" and r.added == [] and r.removed == []


def test_v1_after_v2_live_is_breaking(spark):
    live = T.StructType([T.StructField(k, T._parse_datatype_string(v)) for k, v in V1.items()]
                        + [T.StructField("delivery_partner", T.StringType())])
    r = verdict_of(spark, V1, baseline_schema=live)
    assert r.verdict == "BREAKING" and r.removed == ["delivery_partner"]


def test_seed_versions_resolve_and_unknown_raises(spark):
    for v in ct.SEED_VERSIONS:
        assert ct.seed_path(v).endswith(f"schema_{v}.json")
    with pytest.raises(ct.UnknownContractVersion):
        ct.seed_path("vv1")
    counts = {r[0]: r[1] for r in ct.seed_contracts(spark).groupBy("contract_key").count().collect()}
    assert counts == {"v1": 8, "v2": 9, "v3": 7}


def test_many_batches_in_one_job(spark):
    """Verdicts for many batches against one baseline come from one plan."""
    schemas = {f"b{i}": T.StructType([T.StructField(k, T._parse_datatype_string(v))
                                      for k, v in V1.items() if not (i % 3 == 0 and k == "status")])
               for i in range(30)}
    inc = ct.contract_of(spark, schemas)
    base = ct.seed_contracts(spark, ["v1"])
    pairs = spark.createDataFrame([(k, "v1") for k in schemas], "batch_id string, baseline_key string")
    out = {r.batch_id: r.verdict for r in drift.classify(inc, base, pairs).collect()}
    assert sum(v == "BREAKING" for v in out.values()) == 10 and len(out) == 30


def test_live_contract_absent_vs_present(spark, tmp_path):
    missing = str(tmp_path / "nope")
    assert ct.live_schema(spark, missing) is None
    c, source = ct.baseline_contract(spark, missing)
    assert source == "schema_v1.json" and c.count() == 8
    spark.range(3).withColumn("_ingested_at", F.current_timestamp()).write.parquet(str(tmp_path / "t"))
    c, source = ct.baseline_contract(spark, str(tmp_path / "t"))
    assert source.startswith("live table") and [r.column_name for r in c.collect()] == ["id"]


def test_file_contracts_read_each_footer(spark, tmp_path):
    root = tmp_path / "batch"
    spark.range(5).selectExpr("id").write.parquet(str(root / "a"))
    spark.range(5).selectExpr("cast(id as string) as id", "1 as z").write.parquet(str(root / "b"))
    from lakeguard.sources.files import file_contracts
    rows = file_contracts(spark, str(root)).collect()
    by_dir = {}
    for r in rows:
        by_dir.setdefault(r.path.split("/")[-2], set()).add((r.column_name, r.type))
    assert by_dir["a"] == {("id", "integer")}
    assert by_dir["b"] == {("id", "string"), ("z", "integer")}
