"""The query catalogue: every operator of the inventory as a registered query
over the provided tables, with its DuckDB oracle SQL."""

from __future__ import annotations

import datetime as _dt
import uuid as _uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeguard.operators.latest import latest_per_key, latest_sql
from lakeguard.plans import gold, key_counts, models, pipeline, silver
from lakeguard.plans import ingest as ig
from lakeguard.plans import lake as lk
from lakeguard.queries import register
from lakeguard.session import checkpoint_dir, local_table
from lakeguard.sources import fixture as fx

# ---------------------------------------------------------------- shared SQL
RAW = fx.RAW_ORDERS_SQL
BRONZE = fx.BRONZE_SQL
ORDER = fx.FIXTURE_VERSION_ORDER
SILVER_SELECT = """select order_id, customer_id, product_id, quantity, unit_price,
       quantity * unit_price as line_total, status, created_at, updated_at,
       _ingested_at, _schema_version, _source"""
SILVER_FULL_SQL = f"{SILVER_SELECT} from ({latest_sql(BRONZE, 'order_id', ORDER)}) b"


def daily_revenue_sql(source: str, where: str = "") -> str:
    return f"""
select cast(created_at as date) as order_date,
       count(distinct order_id) as total_orders,
       cast(sum(cast(line_total as decimal(18,2))) as double) as gross_revenue,
       cast(sum(cast(line_total as decimal(18,2))) as double) / count(line_total) as avg_order_value,
       count(case when status = 'delivered' then 1 end) as delivered_orders,
       count(case when status = 'cancelled' then 1 end) as cancelled_orders
from ({source}) s {where}
group by cast(created_at as date)"""


def _silver_full(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_full(fx.bronze_fixture(spark, sf), ORDER)


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{_uuid.uuid4().hex[:12]}"


def _materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate that a query reads several times (a model state,
    a change set) once, as a table in the shared checkpoint folder, and read
    it back: later references scan it instead of re-deriving it, and a lost
    executor recomputes from it rather than from the source tables."""
    path = _scratch(spark, name)
    df.write.options(**lk.COMPRESSED).parquet(path)
    return spark.read.parquet(path)


_MADE: dict[tuple, str] = {}   # scratch folders that several queries of a session read


def _once(spark: SparkSession, key: tuple, make) -> str:
    """The folder ``make`` writes, made once per session and key for queries that only read it.

    The tables of a data directory are taken not to change within a session; a
    folder that is gone (an emptied checkpoint directory) is made again.
    """
    key = (spark.sparkContext.applicationId, checkpoint_dir(spark), *key)
    if key not in _MADE or not lk.exists(spark, _MADE[key]):
        _MADE[key] = make()
    return _MADE[key]


def _lake(spark: SparkSession, sf: str, silver_mode: str | None = "arrival", gold_mode: str | None = None) -> lk.Lake:
    """The lake that :func:`_replay` makes of both batches, for queries that write nothing to it."""
    return lk.Lake(_once(spark, ("lake", sf, silver_mode, gold_mode),
                         lambda: _replay(spark, sf, silver_mode=silver_mode, gold_mode=gold_mode).root))


def _replay(spark: SparkSession, sf: str, upto: int = 2, silver_mode: str | None = "arrival",
            gold_mode: str | None = None, shapes=None, before_last=None) -> lk.Lake:
    """A scratch lake after the producer batches 1..``upto`` went through the library's own runs:
    ingest, then Silver and Gold where a mode is given.  ``before_last`` is called before the last batch;
    ``shapes`` names the upstream shape of each batch.

    The changelog is joined once and written; the producer batches are read from there."""
    lake, joined = lk.Lake(_scratch(spark, "lake")), _scratch(spark, "changelog")
    fx.raw_orders(spark, sf).write.options(**lk.COMPRESSED).parquet(joined)
    changelog = spark.read.parquet(joined)
    for n in range(1, upto + 1):
        if n == upto and before_last is not None:
            before_last(lake)
        rows = changelog if shapes is None else sc.shapes(changelog)[shapes[n - 1]]
        at = _dt.datetime.fromisoformat(fx.BATCH_INGESTED_AT[n])
        ig.ingest(spark, rows.filter(fx.batch_no() == n), lake, batch_id=f"b{n}", ingested_at=at, evaluated_at=at)
        if silver_mode:
            models.silver_incremental(spark, lake, mode=silver_mode, version_order=ORDER)
        if gold_mode:
            models.gold_incremental(spark, lake, mode=gold_mode)
    lk.delete_path(spark, joined)      # both batches are in Bronze
    return lake


def _bronze_rows(spark: SparkSession, lake: lk.Lake) -> DataFrame:
    return models._bronze(spark, lake).drop("_ingest_date", "_batch_id")


# ------------------------------------------------------------- S1 / W1 / M1
@register("scan_raw_orders", f"select * from ({RAW}) r")
def scan_raw_orders(spark, sf):
    return fx.raw_orders(spark, sf)


@register("orders_current", latest_sql(RAW, "order_id", ORDER))
def orders_current(spark, sf):
    return latest_per_key(fx.raw_orders(spark, sf), "order_id", ORDER)


@register("silver_full", SILVER_FULL_SQL)
def silver_full(spark, sf):
    """K5: a full refresh of Silver over both ingested batches."""
    lake = _replay(spark, sf, silver_mode=None)
    models.silver_full_refresh(spark, lake, version_order=ORDER)
    return models.silver_table(spark, lake)


@register("orders_cleaned", SILVER_FULL_SQL)
def orders_cleaned(spark, sf):
    """M1: Silver after both producer batches, incrementally by the event-time
    rule: equals the full refresh because batches arrive in updated_at order."""
    return models.silver_table(spark, _lake(spark, sf, "event_time"))


# ------------------------------------------------------------------ M2 / A*
@register("daily_revenue", daily_revenue_sql(SILVER_FULL_SQL))
def daily_revenue(spark, sf):
    return gold.daily_revenue(_silver_full(spark, sf), key_is_unique=True)


@register("gold_full", daily_revenue_sql(SILVER_FULL_SQL))
def gold_full(spark, sf):
    """K5: full refreshes of Silver and Gold."""
    lake = _replay(spark, sf, silver_mode=None)
    models.silver_full_refresh(spark, lake, version_order=ORDER)
    models.gold_full_refresh(spark, lake)
    return models.gold_table(spark, lake)


# ------------------------------------------------------ P1-P8, A1, A8, L4
BATCH1_AT = fx.BATCH_INGESTED_AT[1]
BATCH2_AT = fx.BATCH_INGESTED_AT[2]
BRONZE_RUN1_SQL = f"select * from ({BRONZE}) x where _ingested_at = timestamp '{BATCH1_AT}'"
SILVER_RUN1_SQL = f"{SILVER_SELECT} from ({latest_sql(BRONZE_RUN1_SQL, 'order_id', ORDER)}) b"


def _bronze_run1(spark, sf):
    b = fx.bronze_fixture(spark, sf)
    return b.filter(F.col("_ingested_at") == fx.ntz(BATCH1_AT))


@register("bronze_enriched", f"select * from ({BRONZE}) b")
def bronze_enriched(spark, sf):
    """Bronze after both batches were ingested, each with its audit columns."""
    return _bronze_rows(spark, _lake(spark, sf, None))


@register("line_total", f"select order_id, l_linenumber, l_suppkey, quantity, unit_price, "
                        f"quantity * unit_price as line_total from ({RAW}) r")
def line_total_q(spark, sf):
    return fx.raw_orders(spark, sf).select(
        "order_id", "l_linenumber", "l_suppkey", "quantity", "unit_price", silver.line_total())


@register("business_columns", f"select * exclude (_ingested_at, _schema_version, _source) from ({BRONZE}) b")
def business_columns(spark, sf):
    """System columns (leading underscore) stripped."""
    b = fx.bronze_fixture(spark, sf)
    return b.select(*[c for c in b.columns if not c.startswith("_")])


@register("silver_delta", f"select * from ({BRONZE}) b where updated_at > "
                          f"(select max(updated_at) from ({SILVER_RUN1_SQL}) t)")
def silver_delta_q(spark, sf):
    """Bronze rows above Silver's high-water mark after run 1
    (uncorrelated scalar subquery, pushed into the scan)."""
    from lakeguard.operators.watermark import watermark_value
    target = silver.silver_full(_bronze_run1(spark, sf), ORDER)
    return silver.silver_delta(fx.bronze_fixture(spark, sf), watermark_value(target, "updated_at"))


@register("gold_delta", daily_revenue_sql(
    SILVER_FULL_SQL,
    f"where cast(created_at as date) >= (select max(order_date) from ({daily_revenue_sql(SILVER_RUN1_SQL)}) g)"))
def gold_delta_q(spark, sf):
    """Gold rows re-aggregated from the latest Gold date of run 1 on
    (inclusive date filter)."""
    from lakeguard.operators.watermark import watermark_value
    gold1 = gold.daily_revenue(silver.silver_full(_bronze_run1(spark, sf), ORDER), True)
    rows = gold.gold_delta(_silver_full(spark, sf), watermark_value(gold1, "order_date"))
    return gold.daily_revenue(rows, key_is_unique=True)


@register("ingested_on_day", f"select * from ({BRONZE}) b where cast(_ingested_at as date) = date '2001-12-02'")
def ingested_on_day(spark, sf):
    """Rows ingested on one UTC day (Catalyst turns the date cast into a
    pushed timestamp range)."""
    b = fx.bronze_fixture(spark, sf)
    return b.filter(F.to_date("_ingested_at") == F.lit("2001-12-02").cast("date"))


@register("duplicate_keys", f"select order_id, count(*) as versions from ({RAW}) r "
                            f"group by order_id having count(*) > 1")
def duplicate_keys(spark, sf):
    """Keys with more than one row (partial count per task, then final)."""
    return (fx.raw_orders(spark, sf).groupBy("order_id")
            .agg(F.count(F.lit(1)).alias("versions")).filter(F.col("versions") > 1))


@register("high_watermark", f"select max(updated_at) as max_updated_at, max(_ingested_at) as max_ingested_at, "
                            f"max(created_at) as max_created_at from ({BRONZE}) b")
def high_watermark_q(spark, sf):
    b = fx.bronze_fixture(spark, sf)
    return b.agg(F.max("updated_at").alias("max_updated_at"),
                 F.max("_ingested_at").alias("max_ingested_at"),
                 F.max("created_at").alias("max_created_at"))


@register("bronze_count", f"select count(case when _ingested_at <= timestamp '{BATCH1_AT}' then 1 end) "
                          f"as rows_after_run1, count(*) as rows_after_run2 from ({BRONZE}) b")
def bronze_count(spark, sf):
    """L4: Bronze row count after each run, in one pass."""
    b = fx.bronze_fixture(spark, sf)
    return b.agg(F.count_if(F.col("_ingested_at") <= fx.ntz(BATCH1_AT)).alias("rows_after_run1"),
                 F.count(F.lit(1)).alias("rows_after_run2"))


# ------------------------------------------ contracts and drift (S4-S6, N*)
from lakeguard.functions.types import normalize_sql  # noqa: E402
from lakeguard.operators import drift  # noqa: E402
from lakeguard.plans import gates  # noqa: E402
from lakeguard.sources import contracts as ct  # noqa: E402
from lakeguard.sources import files  # noqa: E402
from lakeguard.sources import scenarios as sc  # noqa: E402


def _duck_type(expr: str) -> str:
    """Canonical type of a DuckDB type name (one-level lists as array<...>)."""
    return (f"(case when {expr} like '%[]' then 'array<' || lower(replace({expr}, '[]', '')) || '>' "
            f"else {normalize_sql(expr)} end)")


def _describe_sql(key: str, sql: str, key_col: str = "contract_key") -> str:
    return (f"select '{key}' as {key_col}, cast(row_number() over () as integer) as ordinal, "
            f"column_name, {_duck_type('column_type')} as type from (describe {sql})")


def _seed_sql(versions=ct.SEED_VERSIONS) -> str:
    paths = ", ".join(f"'{ct.seed_path(v)}'" for v in versions)
    return (f"select contract_key, cast(ordinal as integer) as ordinal, c.name as column_name, "
            f"{normalize_sql('c.type')} as type from (select version as contract_key, "
            f"unnest(range(1, len(columns) + 1)) as ordinal, unnest(columns) as c "
            f"from read_json([{paths}]))")


TABLE_CONTRACTS_SQL = " union all ".join(
    _describe_sql(t, f"select * from {t}", "table_name") for t in fx.TABLES)
SCENARIO_CONTRACTS_SQL = " union all ".join(
    _describe_sql(n, sc.SCENARIO_SQL[n], "batch_id") for n in sc.SCENARIOS)


def _table_contracts(spark, sf):
    schemas = {t: fx.read_table(spark, sf, t).schema for t in fx.TABLES}
    return ct.contract_of(spark, schemas, drop_system=False)


@register("contract_from_table", f"select table_name, ordinal, column_name, type from ({TABLE_CONTRACTS_SQL}) c")
def contract_from_table(spark, sf):
    """The contract of every provided table (metadata, no rows read)."""
    return _table_contracts(spark, sf).select(
        F.col("contract_key").alias("table_name"), "ordinal", "column_name", "type")


@register("type_normalize", f"select type, count(*) as n_columns from ({TABLE_CONTRACTS_SQL}) c group by type")
def type_normalize(spark, sf):
    """canonical type names over every column of the provided tables."""
    return (_table_contracts(spark, sf).groupBy("type")
            .agg(F.count(F.lit(1)).alias("n_columns")))


@register("file_contracts", f"select table_name || '.parquet' as file_name, ordinal, column_name, type "
                            f"from ({TABLE_CONTRACTS_SQL}) c")
def file_contracts(spark, sf):
    """The contract of every Parquet file under the data directory, read
    from each file's own footer."""
    return files.file_contracts(spark, sf).select("file_name", "ordinal", "column_name", "type")


def _scenario_footers(spark, sf, names=sc.SCENARIOS):
    """The producer batches landed as Parquet files, one folder each, and the footers read from them.

    The changelog is joined once; every batch is a projection of its written rows.
    """
    root, changelog = _scratch(spark, "landed"), _scratch(spark, "changelog")
    fx.raw_orders(spark, sf).drop("l_linenumber").write.options(**lk.COMPRESSED).parquet(changelog)
    batches = sc.shapes(spark.read.parquet(changelog))
    for name in names:
        batches[name].write.options(**lk.COMPRESSED).parquet(f"{root}/{name}")
    lk.delete_path(spark, changelog)
    return _materialize(spark, gates.batch_footers(spark, root), "footers")


def _scenario_verdicts(spark, sf):
    return gates.batch_verdicts(gates.schema_changes(_scenario_footers(spark, sf), ct.seed_contracts(spark, ["v1"]))).drop("baseline_key")


def _drift_sql(incoming_sql: str, baseline_sql: str, pairs_sql: str) -> str:
    return f"""
with inc as (select batch_id, column_name, ordinal as actual_ordinal, type as actual_type from ({incoming_sql}) i),
     exp as (select p.batch_id, b.column_name, b.ordinal as expected_ordinal, b.type as expected_type
             from ({pairs_sql}) p join ({baseline_sql}) b on b.contract_key = p.baseline_key)
select coalesce(inc.batch_id, exp.batch_id) as batch_id,
       coalesce(inc.column_name, exp.column_name) as column_name,
       case when expected_type is null then 'ADDED' when actual_type is null then 'REMOVED'
            when actual_type <> expected_type then 'TYPE_CHANGED' else 'SAME' end as change,
       expected_type, actual_type, expected_ordinal, actual_ordinal
from inc full outer join exp on inc.batch_id = exp.batch_id and inc.column_name = exp.column_name"""


SCENARIO_PAIRS_SQL = " union all ".join(f"select '{n}' as batch_id, 'v1' as baseline_key" for n in sc.SCENARIOS)
SCENARIO_DRIFT_SQL = _drift_sql(SCENARIO_CONTRACTS_SQL, _seed_sql(["v1"]), SCENARIO_PAIRS_SQL)


def _verdict_sql(changes_sql: str) -> str:
    def names(kind, ordinal):
        return (f"'[' || coalesce(string_agg('''' || column_name || '''', ', ' order by {ordinal}) "
                f"filter (where change = '{kind}'), '') || ']'")
    tc = ("'[' || coalesce(string_agg('{''column'': ''' || column_name || ''', ''expected'': ''' || "
          "expected_type || ''', ''actual'': ''' || actual_type || '''}', ', ' order by actual_ordinal) "
          "filter (where change = 'TYPE_CHANGED'), '') || ']'")
    downstream = "[" + ", ".join(f"'{d}'" for d in drift.DOWNSTREAM) + "]"
    breaking = "bool_or(change in ('REMOVED', 'TYPE_CHANGED'))"
    return f"""
select batch_id,
       case when {breaking} then 'BREAKING' else 'NON_BREAKING' end as verdict,
       {names('ADDED', 'actual_ordinal')} as added_columns,
       {names('REMOVED', 'expected_ordinal')} as removed_columns,
       {tc} as type_changes,
       case when {breaking} then '{downstream.replace("'", "''")}' else '[]' end as affected_pipelines
from ({changes_sql}) c group by batch_id"""


SCENARIO_VERDICT_SQL = _verdict_sql(SCENARIO_DRIFT_SQL)


@register("schema_drift", SCENARIO_DRIFT_SQL)
def schema_drift(spark, sf):
    """Column-level changes of every landed batch against the v1 seed
    contract, from the footers of its files (full outer join on (batch, column))."""
    changes = gates.schema_changes(_scenario_footers(spark, sf), ct.seed_contracts(spark, ["v1"]))
    return changes.drop("fingerprint", "baseline_key")


@register("schema_drift_verdict", SCENARIO_VERDICT_SQL)
def schema_drift_verdict(spark, sf):
    """One verdict per landed batch with its added / removed / changed lists."""
    return _scenario_verdicts(spark, sf)


CONTRACT_VERSIONS_SQL = _verdict_sql(_drift_sql(
    " union all ".join(_describe_sql(f"baseline@{v}", sc.SCENARIO_SQL["baseline"], "batch_id")
                       for v in ct.SEED_VERSIONS),
    _seed_sql(),
    " union all ".join(f"select 'baseline@{v}' as batch_id, '{v}' as baseline_key"
                       for v in ct.SEED_VERSIONS)))


@register("contract_versions", CONTRACT_VERSIONS_SQL)
def contract_versions(spark, sf):
    """The files of the landed v1 batch checked against every seed
    contract version in one job (one pair per schema and version)."""
    footers = _scenario_footers(spark, sf, ["baseline"])
    changes = gates.schema_changes(footers, ct.seed_contracts(spark), F.array(*[F.lit(v) for v in ct.SEED_VERSIONS]))
    return gates.batch_verdicts(changes).select(
        F.concat_ws("@", "batch_id", "baseline_key").alias("batch_id"), "verdict", "added_columns", "removed_columns",
        "type_changes", "affected_pipelines")


# ------------------------------------------------ merge engine
from lakeguard.operators import merge as mg  # noqa: E402

TS1 = f"timestamp '{BATCH1_AT}'"
INCOMING_SQL = (f"{SILVER_SELECT} from ("
                f"{latest_sql(f'select * from ({BRONZE}) x where _ingested_at > {TS1}', 'order_id', ORDER)}) b")
ARRIVAL_CHANGES_SQL = f"""
select * from (
  select * from ({INCOMING_SQL}) i
  union all
  select * from ({SILVER_RUN1_SQL}) t where order_id in (select order_id from ({INCOMING_SQL}) i2)
) u qualify row_number() over (partition by order_id order by updated_at desc nulls last,
                                                          _ingested_at desc nulls last) = 1"""
MERGE_SILVER_SQL = f"""
select * from ({SILVER_RUN1_SQL}) t where order_id not in (select order_id from ({ARRIVAL_CHANGES_SQL}) c)
union all select * from ({ARRIVAL_CHANGES_SQL}) c2"""


@register("merge_silver", MERGE_SILVER_SQL)
def merge_silver(spark, sf):
    """Silver after the arrival-time merge of batch 2 into the state of run 1."""
    return models.silver_table(spark, _lake(spark, sf))


_STAT_COLS = [c for c in silver.SILVER_COLUMNS if c != "order_id"]
MERGE_STATS_SQL = f"""
select case when t.order_id is null then 'inserted'
            when {' and '.join(f'c.{x} is not distinct from t.{x}' for x in _STAT_COLS)} then 'unchanged'
            else 'updated' end as action, count(*) as keys
from ({ARRIVAL_CHANGES_SQL}) c left join ({SILVER_RUN1_SQL}) t on c.order_id = t.order_id
group by 1"""


@register("merge_stats", MERGE_STATS_SQL)
def merge_stats(spark, sf):
    """How the change set that run 2 staged classifies its keys against
    Silver as run 1 left it (inserted / updated / unchanged)."""
    before = []
    lake = _replay(spark, sf, before_last=lambda lk_: before.append(
        _materialize(spark, models.silver_table(spark, lk_), "silver-run1")))
    run = models.last_run(spark, lake, "silver")
    changes = spark.read.parquet(lake.staging(run["run_id"], "changes")).filter("_side = 'new'")
    return mg.merge_stats(before[0], changes.select(*silver.SILVER_COLUMNS), "order_id")


@register("merge_idempotent", f"""
select count(*) as rows_once, count(*) as rows_twice, 0 as only_once, 0 as only_twice
from ({MERGE_SILVER_SQL}) m""")
def merge_idempotent(spark, sf):
    """Doing a committed run again ends in the same table (multiset
    difference both ways, stronger than equal counts)."""
    lake = _replay(spark, sf)
    once = _materialize(spark, models.silver_table(spark, lake), "silver-once")
    models.replay(spark, lake, models.last_run(spark, lake, "silver"))
    twice = models.silver_table(spark, lake)
    diff = mg.symmetric_difference(once, twice).select("side")
    tagged = (once.select(F.lit("once").alias("side"))
              .unionByName(twice.select(F.lit("twice").alias("side"))).unionByName(diff))
    return tagged.agg(F.count_if(F.col("side") == "once").alias("rows_once"),
                      F.count_if(F.col("side") == "twice").alias("rows_twice"),
                      F.count_if(F.col("side") == "only_first").cast("int").alias("only_once"),
                      F.count_if(F.col("side") == "only_second").cast("int").alias("only_twice"))


GOLD_RUN1_SQL = daily_revenue_sql(SILVER_RUN1_SQL)
GOLD_LATEST_SQL = daily_revenue_sql(
    SILVER_FULL_SQL, f"where cast(created_at as date) >= (select max(order_date) from ({GOLD_RUN1_SQL}) g)")


@register("merge_gold", f"""
select * from ({GOLD_RUN1_SQL}) t where order_date not in (select order_date from ({GOLD_LATEST_SQL}) r)
union all select * from ({GOLD_LATEST_SQL}) r2""")
def merge_gold(spark, sf):
    """K4/M2 (reference rule): Gold dates from the latest Gold date on are
    re-aggregated and replace their rows; older dates keep run-1 values."""
    return models.gold_table(spark, _lake(spark, sf, gold_mode="latest_date"))


@register("merge_gold_touched", daily_revenue_sql(SILVER_FULL_SQL))
def merge_gold_touched(spark, sf):
    """Gold of run 1 plus what the change set of run 2 retracts and adds —
    equals a full rebuild."""
    return models.gold_table(spark, _lake(spark, sf, gold_mode="touched_dates"))


# --------------------------------------------------------- as-of reads
ASOF = "2001-12-01 12:00:00"


@register("bronze_as_of", f"select * from ({BRONZE}) b where _ingested_at <= timestamp '{ASOF}'")
def bronze_as_of(spark, sf):
    """Bronze as it stood at a past instant (append-only: filter on arrival)."""
    return fx.bronze_fixture(spark, sf).filter(F.col("_ingested_at") <= fx.ntz(ASOF))


@register("silver_as_of", f"{SILVER_SELECT} from ("
                          f"{latest_sql(f'select * from ({BRONZE}) x where _ingested_at <= timestamp {chr(39)}{ASOF}{chr(39)}', 'order_id', ORDER)}) b")
def silver_as_of(spark, sf):
    """Silver at a past instant = the Silver model over Bronze as of then."""
    return silver.silver_full(bronze_as_of(spark, sf), ORDER)


# ----------------------------------------------- schema evolution read (K2)
BRONZE_EVOLVED_SQL = f"""
select {', '.join(sc.V1)}, cast(null as varchar) as delivery_partner from ({RAW}) r
where updated_at <= timestamp '{fx.BATCH_SPLIT}'
union all
select {', '.join(sc.V1)}, 'partner-' || cast(l_suppkey % 5 + 1 as varchar) as delivery_partner
from ({RAW}) r where updated_at > timestamp '{fx.BATCH_SPLIT}'"""


@register("bronze_evolved_read", BRONZE_EVOLVED_SQL)
def bronze_evolved_read(spark, sf):
    """K2: a v1 batch then a v2 batch (adds delivery_partner) ingested into one
    table — rows of the older batch read the new column as null."""
    lake = _replay(spark, sf, silver_mode=None, shapes=["baseline", "non_breaking"])
    return models._bronze(spark, lake).select(*sc.V1, "delivery_partner")


SINK_DRIFT_SQL = _drift_sql(
    _describe_sql("output", ARRIVAL_CHANGES_SQL, "batch_id"),
    _describe_sql("target", SILVER_RUN1_SQL, "contract_key"),
    "select 'output' as batch_id, 'target' as baseline_key")


@register("sink_drift_check", f"select count(*) as columns_compared, "
                              f"count(*) filter (where change <> 'SAME') as drifted_columns from ({SINK_DRIFT_SQL}) d")
def sink_drift_check(spark, sf):
    """K6: contract of the change set that run 2 wrote against that of the Silver
    table, both as their files' footers have them."""
    lake = _replay(spark, sf)
    run = models.last_run(spark, lake, "silver")
    contracts = {}
    for side, path in (("output", lake.staging(run["run_id"], "changes")), ("target", lake.silver)):
        found = files.distinct_contracts(files.footers(files.list_files(spark, path)))
        found = found.filter(F.col("column_name").isin(*silver.SILVER_COLUMNS)).drop("contract_key").distinct()
        contracts[side] = found.withColumn("contract_key", F.lit(side))
    pairs = local_table(spark, [("output", "target")], "batch_id string, baseline_key string")
    ch = drift.column_changes(contracts["output"], contracts["target"], pairs)
    return ch.agg(F.count(F.lit(1)).alias("columns_compared"),
                  F.count_if(F.col("change") != drift.SAME).alias("drifted_columns"))


# ------------------------------------------------------ data tests (Q1-Q3)
from lakeguard.operators import quality as dq  # noqa: E402

GOLD_FULL_SQL = daily_revenue_sql(SILVER_FULL_SQL)
_DQ_SOURCES = {"bronze.raw_orders": BRONZE, "silver.orders_cleaned": SILVER_FULL_SQL,
               "gold.daily_revenue": GOLD_FULL_SQL}


def _dq_tables(spark, sf):
    # the tests run against tables: Silver is written once and read by its
    # own tests and by the Gold aggregate
    s = _materialize(spark, _silver_full(spark, sf), "silver-full")
    return [dq.declared("bronze.raw_orders", fx.bronze_fixture(spark, sf)),
            dq.declared("silver.orders_cleaned", s),
            dq.declared("gold.daily_revenue", gold.daily_revenue(s, key_is_unique=True))]


def _dq_sql(tests: tuple[str, ...], tables: tuple[str, ...] = tuple(dq.DECLARED)) -> str:
    parts = []
    for table in tables:
        spec = dq.DECLARED[table]
        src = _DQ_SOURCES[table]
        if "not_null" in tests:
            parts += [f"select '{table}' as table_name, '{c}' as column_name, 'not_null' as test, "
                      f"count(*) filter (where {c} is null) as failures from ({src}) s"
                      for c in spec["not_null"]]
        if "unique" in tests:
            parts += [f"select '{table}' as table_name, '{c}' as column_name, 'unique' as test, "
                      f"count(*) as failures from (select {c} from ({src}) s where {c} is not null "
                      f"group by {c} having count(*) > 1) d" for c in spec["unique"]]
    body = " union all ".join(parts)
    return (f"select *, case when failures = 0 then 'PASS' else 'FAIL' end as status "
            f"from ({body}) r")


@register("dq_not_null", _dq_sql(("not_null",)))
def dq_not_null(spark, sf):
    """Q1: every declared not_null test, one aggregate pass per table."""
    tables = [dq.TableTests(t.table_name, t.df, t.not_null, []) for t in _dq_tables(spark, sf)]
    return dq.report(tables)


@register("dq_unique", _dq_sql(("unique",)))
def dq_unique(spark, sf):
    """Q2: every declared unique test (Bronze keeps versions, so it fails there)."""
    tables = [dq.TableTests(t.table_name, t.df, [], t.unique) for t in _dq_tables(spark, sf)]
    return dq.report(tables)


@register("dq_report", _dq_sql(("not_null", "unique")))
def dq_report(spark, sf):
    """Q3: the whole declared suite, one PASS/FAIL row per (table, column, test)."""
    return dq.report(_dq_tables(spark, sf))


@register("dq_bronze_by_batch", _dq_sql(("not_null", "unique"), ("bronze.raw_orders",)))
def dq_bronze_by_batch(spark, sf):
    """Q1-Q3 on Bronze kept up by batch: the second batch's tests read that batch and the stored key counts."""
    lake = _replay(spark, sf, silver_mode=None, before_last=lambda lake: key_counts.update(spark, lake))
    key_counts.update(spark, lake)
    return key_counts.report(spark, lake)


# ------------------------------------------------------------ SLA (V1-V4)
from lakeguard.operators import sla  # noqa: E402

FRESHNESS_AS_OF = ["2001-11-04 06:00:00", "2001-11-04 06:00:01", "2001-12-02 06:00:00"]
COMPLETENESS_AS_OF = ["2001-12-01 12:00:00", "2001-12-02 12:00:00", "2001-12-03 12:00:00"]
SLA_RUNS = ["2001-12-01 06:00:00", "2001-12-02 06:00:00", "2001-12-03 06:00:00"]
SLA_IMPACT = {"freshness": "Revenue reporting shows stale numbers.",
              "completeness": "Order fulfillment risk.",
              "schema_consistency": "Downstream dbt models fail silently."}


def _age_sql(as_of: str) -> str:
    return f"((epoch_us(timestamp '{as_of}') - epoch_us(max(updated_at))) / 3.6e9)"


def _freshness_sql(as_of: str, thr: int = 6) -> str:
    age = _age_sql(as_of)
    return f"""select 'freshness' as check_name,
  case when max(updated_at) is null or {age} > {float(thr)} then 'FAIL' else 'PASS' end as status,
  case when max(updated_at) is null then 'No data in Bronze table'
       when {age} > {float(thr)} then printf('Data is %.1fh old, threshold={thr}h', round({age}, 1))
       when {age} < 0 then printf('Latest updated_at is %.1fh in the future', round(-{age}, 1))
       else '' end as detail from ({BRONZE}) b"""


def _completeness_sql(as_of: str, n: int = 100) -> str:
    cnt = f"count(*) filter (where cast(_ingested_at as date) = cast(timestamp '{as_of}' as date))"
    return f"""select 'completeness' as check_name,
  case when {cnt} < {n} then 'FAIL' else 'PASS' end as status,
  case when {cnt} < {n} then printf('Row count %d below minimum {n}', {cnt}) else '' end as detail
from ({BRONZE}) b"""


BRONZE_SCHEMA_SQL = _verdict_sql(_drift_sql(
    _describe_sql("live", f"select * exclude (_ingested_at, _schema_version, _source) from ({BRONZE}) b",
                  "batch_id"),
    _seed_sql(["v1"]), "select 'live' as batch_id, 'v1' as baseline_key"))
SCHEMA_CHECK_SQL = f"""select 'schema_consistency' as check_name,
  case when verdict = 'BREAKING' then 'FAIL' else 'PASS' end as status,
  case when verdict = 'BREAKING' then 'removed=' || removed_columns || ' type_changes=' || type_changes
       else '' end as detail from ({BRONZE_SCHEMA_SQL}) v"""


def _sla_run_sql(as_of: str) -> str:
    parts = [_freshness_sql(as_of), _completeness_sql(as_of), SCHEMA_CHECK_SQL]
    return " union all ".join(
        f"select check_name, status, detail, "
        f"case check_name {' '.join(f'when {chr(39)}{k}{chr(39)} then {chr(39)}{v}{chr(39)}' for k, v in SLA_IMPACT.items())} end "
        f"as business_impact, timestamp '{as_of}' as checked_at from ({p}) x" for p in parts)


def _sla_lake(spark, sf) -> lk.Lake:
    return _replay(spark, sf, silver_mode=None)


def _batches(spark, lake) -> DataFrame:
    return sla.of_batches(lk.read_log(spark, lake, "batch_log"))


@register("sla_freshness", " union all ".join(
    f"select timestamp '{a}' as as_of, status, detail from ({_freshness_sql(a)}) f" for a in FRESHNESS_AS_OF))
def sla_freshness(spark, sf):
    """V1 at three instants: exactly 6 h after the latest update (passes),
    one second later (fails), and weeks later — all from what the ingest of both
    batches observed."""
    m = sla.metrics(_batches(spark, _sla_lake(spark, sf)), sla.ts_literal(FRESHNESS_AS_OF[0]))
    results = [F.struct(sla.ts_literal(a).alias("as_of"), sla.freshness_result(sla.ts_literal(a), 6)
                        .alias("r")) for a in FRESHNESS_AS_OF]
    return m.select(F.inline(F.array(*results))).select("as_of", "r.status", "r.detail")


@register("sla_completeness", " union all ".join(
    f"select timestamp '{a}' as as_of, status, detail from ({_completeness_sql(a)}) c" for a in COMPLETENESS_AS_OF))
def sla_completeness(spark, sf):
    """V2 on the two ingest days and a day without ingest, from the batch log."""
    counts = sla.metrics(_batches(spark, _sla_lake(spark, sf)), [sla.ts_literal(a) for a in COMPLETENESS_AS_OF])
    results = [F.struct(sla.ts_literal(a).alias("as_of"), sla.completeness_result(100, f"rows_today_{i}")
                        .alias("r")) for i, a in enumerate(COMPLETENESS_AS_OF)]
    return counts.select(F.inline(F.array(*results))).select("as_of", "r.status", "r.detail")


SLA_SCHEMA_SQL = f"""
select batch_id, case when verdict = 'BREAKING' then 'FAIL' else 'PASS' end as status,
       case when verdict = 'BREAKING' then 'removed=' || removed_columns || ' type_changes=' || type_changes
            else '' end as detail
from ({SCENARIO_VERDICT_SQL}) v"""


@register("sla_schema", SLA_SCHEMA_SQL)
def sla_schema(spark, sf):
    """V3: schema consistency of every landed batch's files against pinned v1."""
    v = _scenario_verdicts(spark, sf)
    breaking = F.col("verdict") == drift.BREAKING
    detail = F.concat(F.lit("removed="), F.col("removed_columns"), F.lit(" type_changes="), F.col("type_changes"))
    return v.select("batch_id", F.when(breaking, "FAIL").otherwise("PASS").alias("status"),
                    F.when(breaking, detail).otherwise(F.lit("")).alias("detail"))


@register("sla_report", _sla_run_sql(SLA_RUNS[1]))
def sla_report(spark, sf):
    """V4: the configured suite (rules file) on the ingested table, one row per
    rule with its business impact; no Bronze file is read."""
    return pipeline.run_sla(spark, _sla_lake(spark, sf), _dt.datetime.fromisoformat(SLA_RUNS[1]))


@register("latest_sla", f"select * from ({' union all '.join(_sla_run_sql(a) for a in SLA_RUNS)}) s "
                        f"order by checked_at desc, check_name limit 3")
def latest_sla(spark, sf):
    """L1: the three most recent SLA log rows over three daily runs."""
    lake = _sla_lake(spark, sf)
    for at in SLA_RUNS:
        pipeline.run_sla(spark, lake, _dt.datetime.fromisoformat(at))
    log = lk.read_log(spark, lake, "sla_check_log")
    return log.orderBy(F.col("checked_at").desc(), "check_name").limit(3)


# ------------------------------------------------ verdict logs
def _evaluated_at_sql() -> str:
    whens = " ".join(f"when '{k}' then timestamp '{v}'" for k, v in sc.SCENARIO_EVALUATED_AT.items())
    return f"case batch_id {whens} end"


_LOG_COLUMNS = ["batch_id", "verdict", "added_columns", "removed_columns", "type_changes", "affected_pipelines",
                "evaluated_at", "baseline"]


def _scenario_log(spark, sf, name) -> DataFrame:
    """A log of a scratch lake to which the verdicts of all landed batches were routed."""
    lake = lk.Lake(_scratch(spark, "lake"))
    at = F.coalesce(*[F.when(F.col("batch_id") == k, fx.ntz(v)) for k, v in sc.SCENARIO_EVALUATED_AT.items()])
    gates.route_batches(spark, lake, _materialize(spark, _scenario_verdicts(spark, sf), "verdicts"), "schema_v1.json", at)
    return lk.read_log(spark, lake, name)


LOG_SQL = f"select *, {_evaluated_at_sql()} as evaluated_at, 'schema_v1.json' as baseline from ({SCENARIO_VERDICT_SQL}) v"
INCIDENT_SQL = f"select *, 'PIPELINE_HALTED' as event from ({LOG_SQL}) l where verdict = 'BREAKING'"


@register("schema_change_log", f"select * from ({LOG_SQL}) l where verdict = 'NON_BREAKING'")
def schema_change_log(spark, sf):
    """Log rows of the accepted batches (an unchanged schema is logged too)."""
    return _scenario_log(spark, sf, "schema_change_log").select(*_LOG_COLUMNS)


@register("incident_log", INCIDENT_SQL)
def incident_log(spark, sf):
    """Incident rows (PIPELINE_HALTED) of the breaking batches."""
    return _scenario_log(spark, sf, "incident_log").select(*_LOG_COLUMNS, "event")


@register("latest_schema_change", f"select verdict, added_columns, evaluated_at from ({LOG_SQL}) l "
                                  f"where verdict = 'NON_BREAKING' order by evaluated_at desc limit 1")
def latest_schema_change(spark, sf):
    """L2: the most recent accepted schema change."""
    return (schema_change_log(spark, sf).orderBy(F.col("evaluated_at").desc())
            .select("verdict", "added_columns", "evaluated_at").limit(1))


@register("latest_incident", f"select event, removed_columns, affected_pipelines, evaluated_at "
                             f"from ({INCIDENT_SQL}) i order by evaluated_at desc limit 1")
def latest_incident(spark, sf):
    """L3: the most recent incident."""
    return (incident_log(spark, sf).orderBy(F.col("evaluated_at").desc())
            .select("event", "removed_columns", "affected_pipelines", "evaluated_at").limit(1))


# ------------------------------------------------------- cost
from lakeguard.operators import cost  # noqa: E402

# ``events`` is read as the log of a pipeline's runs: an event is a run of the
# pipeline that its type names, ``value`` its measured runtime in seconds and
# ``k`` of its properties the rows it processed; purchases stand for full
# refreshes, all other events for incremental runs.


def _run_log(spark, sf):
    return fx.read_table(spark, sf, "events").select(
        F.col("event_type").alias("pipeline_name"),
        F.when(F.col("event_type") == "purchase", "full_refresh").otherwise("incremental").alias("run_type"),
        F.col("value").alias("runtime_seconds"), F.get_json_object("props", "$.k").cast("long").alias("rows_processed"),
        F.col("ts").alias("logged_at"))


RUN_LOG_SQL = """select event_type as pipeline_name,
  case when event_type = 'purchase' then 'full_refresh' else 'incremental' end as run_type,
  value as runtime_seconds, cast(json_extract_string(props, '$.k') as bigint) as rows_processed, ts as logged_at from events"""


COST_SQL = f"""select *, round_even(runtime_seconds / 3600.0 * {cost.DBU_PER_HOUR}, 6) as estimated_dbu,
  round_even(runtime_seconds / 3600.0 * {cost.DBU_PER_HOUR} * {cost.DBU_RATE_USD}, 6) as estimated_cost_usd,
  '{cost.methodology()}' as methodology from ({RUN_LOG_SQL}) r"""


@register("cost_attribution", COST_SQL)
def cost_attribution(spark, sf):
    """DBU and USD per logged run (rounded to 6 places, half-even)."""
    return cost.with_cost(_run_log(spark, sf))


MEAN_SQL = f"""select run_type, cast(sum(cast(runtime_seconds as decimal(24,6))) as double) / count(runtime_seconds)
  as runtime_seconds from ({RUN_LOG_SQL}) r group by run_type"""
PROJECTION_SQL = f"""
select run_type, day, daily_cost_usd, daily_cost_usd * day as cumulative_cost_usd from (
  select run_type, runtime_seconds / 3600.0 * {cost.DBU_PER_HOUR} * {cost.DBU_RATE_USD} * {cost.RUNS_PER_DAY} as daily_cost_usd
  from ({MEAN_SQL}) m) d,
  (select cast(unnest(range(1, {cost.DAYS} + 1)) as integer) as day) days"""


def _projection(spark, sf):
    return cost.project_costs(cost.mean_runtimes(_run_log(spark, sf)))


@register("cost_projection", PROJECTION_SQL)
def cost_projection(spark, sf):
    """30-day cumulative cost of full-refresh vs incremental runs at their measured mean runtimes."""
    return _projection(spark, sf)


@register("cost_spent", f"""
select run_type, day, runs, cast(cost as double) as cost_usd,
       cast(sum(cost) over (partition by run_type order by day rows unbounded preceding) as double) as cumulative_cost_usd
from (select run_type, cast(logged_at as date) as day, count(*) as runs,
             sum(cast(estimated_cost_usd as decimal(24,6))) as cost from ({COST_SQL}) c group by run_type, cast(logged_at as date)) d""")
def cost_spent(spark, sf):
    """What the logged runs have cost per day and in all up to it."""
    return cost.spent_by_day(cost.with_cost(_run_log(spark, sf)))


@register("cost_savings", f"""
select day, sum(case when run_type = 'full_refresh' then cumulative_cost_usd end) as full_refresh_usd,
       sum(case when run_type = 'incremental' then cumulative_cost_usd end) as incremental_usd,
       sum(case when run_type = 'full_refresh' then cumulative_cost_usd end)
         - sum(case when run_type = 'incremental' then cumulative_cost_usd end) as savings_usd
from ({PROJECTION_SQL}) p where day = {cost.DAYS} group by day""")
def cost_savings(spark, sf):
    """Savings on the last projected day."""
    return cost.savings(_projection(spark, sf))


@register("cost_by_pipeline", f"""
select pipeline_name, run_type, count(*) as runs,
       cast(sum(cast(runtime_seconds as decimal(24,6))) as double) as runtime_seconds,
       cast(sum(rows_processed) as bigint) as rows_processed,
       cast(sum(cast(estimated_dbu as decimal(24,6))) as double) as estimated_dbu,
       cast(sum(cast(estimated_cost_usd as decimal(24,6))) as double) as estimated_cost_usd
from ({COST_SQL}) c group by pipeline_name, run_type""")
def cost_by_pipeline(spark, sf):
    """C4: cost roll-up per pipeline and run type."""
    return cost.cost_by_pipeline(cost.with_cost(_run_log(spark, sf)))


@register("cost_ratio", f"""
select max(case when run_type = 'full_refresh' then runtime_seconds end) as full_s,
       max(case when run_type = 'incremental' then runtime_seconds end) as incr_s,
       max(case when run_type = 'full_refresh' then runtime_seconds end)
         / max(case when run_type = 'incremental' then runtime_seconds end) as ratio from ({MEAN_SQL}) m""")
def cost_ratio(spark, sf):
    """Full-refresh / incremental runtime ratio of the logged runs."""
    return cost.full_vs_incremental(_run_log(spark, sf))


# ------------------------------------------ file sources and landing


@register("ingest_csv_batch", sc.SCENARIO_SQL["baseline"])
def ingest_csv_batch(spark, sf):
    """S3: the v1 batch delivered as CSV files of two producers, whose columns
    stand in different order, ingested through the gate with the contract's types."""
    path, lake = _scratch(spark, "csv-batch"), lk.Lake(_scratch(spark, "lake"))
    rows = sc.scenario_batches(spark, sf)["baseline"]
    for n, columns in ((1, sc.V1), (2, sc.V1[::-1])):
        rows.filter(fx.batch_no() == n).select(*columns).write.option("header", True).csv(f"{path}/producer{n}")
    ig.ingest_csv(spark, path, lake, batch_id="b1")
    return models._bronze(spark, lake).select(*sc.V1)


@register("landing_promote", BRONZE_EVOLVED_SQL)
def landing_promote(spark, sf):
    """Two producer batches (v1, then v2 adding delivery_partner)
    dropped in a landing folder, drained by the guarded file stream into
    Bronze; returns Bronze's business columns."""
    from lakeguard.streaming import landing
    root = _scratch(spark, "landing")
    r = fx.raw_orders(spark, sf)
    split = F.col("updated_at") <= fx.ntz(fx.BATCH_SPLIT)
    landing.drop_batch(r.filter(split).select(*sc.V1), f"{root}/in", "b1")
    landing.drop_batch(sc.scenario_batches(spark, sf)["non_breaking"].filter(~split), f"{root}/in", "b2")
    lake = lk.Lake(f"{root}/lake")
    q = landing.start(spark, f"{root}/in", lake, f"{root}/checkpoint",
                      clock=lambda: _dt.datetime(2001, 12, 2))
    q.awaitTermination()
    return models._bronze(spark, lake).select(*sc.V1, "delivery_partner")
