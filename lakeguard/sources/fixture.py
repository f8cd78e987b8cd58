"""Order changelog over the provided TPC-H-style tables.

Every ``lineitem`` row of an order is read as one *version* of that order:
``lineitem ⋈ orders`` on the order key gives a stream of mutable order
records with the raw-orders contract (order_id, customer_id, product_id,
quantity, unit_price, status, created_at, updated_at).  ``l_linenumber`` and
``l_suppkey`` ride along only to make "latest version" a total order.

Producer batches and their ingest times are derived from the data
(``updated_at``), never from the wall clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

BUSINESS_COLUMNS = ["order_id", "customer_id", "product_id", "quantity", "unit_price",
                    "status", "created_at", "updated_at"]
TIE_BREAK_COLUMNS = ["l_linenumber", "l_suppkey"]
# Total order of versions of one order_id in the fixture (all descending).
FIXTURE_VERSION_ORDER = ["updated_at", "l_linenumber", "product_id", "l_suppkey"]

# Fixed values of the two-batch replay used by queries and tests.
BATCH_SPLIT = "1999-01-01 00:00:00"
BATCH_INGESTED_AT = {1: "2001-12-01 00:00:00", 2: "2001-12-02 00:00:00"}
PIPELINE_ID = "ingest_bronze_v1"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ntz(value: str) -> Column:
    """A ``timestamp_ntz`` literal (zone-free, so session zone never matters)."""
    return F.lit(value).cast("timestamp_ntz")


def status_expr() -> Column:
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    return (F.when((rf == "R") & (ls == "F"), "cancelled")
            .when((rf == "A") & (ls == "F"), "delivered")
            .when(ls == "F", "shipped")
            .when(rf == "N", "pending")
            .otherwise("confirmed"))


def raw_orders(spark: SparkSession, sf_dir: str, with_tie_break: bool = True) -> DataFrame:
    """The changelog view: one row per lineitem, raw-orders contract."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", status_expr().alias("status"), "l_shipdate")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    cols = [
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        F.col("status"),
        F.col("o_orderdate").alias("created_at"),
        F.greatest("o_orderdate", "l_shipdate").alias("updated_at"),
    ]
    if with_tie_break:
        cols += [F.col(c) for c in TIE_BREAK_COLUMNS]
    return joined.select(*cols)


RAW_ORDERS_SQL = """
select cast(l_orderkey as varchar) as order_id,
       cast(o_custkey as varchar) as customer_id,
       cast(l_partkey as varchar) as product_id,
       cast(l_quantity as integer) as quantity,
       l_extendedprice as unit_price,
       case when l_returnflag = 'R' and l_linestatus = 'F' then 'cancelled'
            when l_returnflag = 'A' and l_linestatus = 'F' then 'delivered'
            when l_linestatus = 'F' then 'shipped'
            when l_returnflag = 'N' then 'pending'
            else 'confirmed' end as status,
       o_orderdate as created_at,
       greatest(o_orderdate, l_shipdate) as updated_at,
       l_linenumber, l_suppkey
from lineitem join orders on l_orderkey = o_orderkey
"""


def batch_no() -> Column:
    return F.when(F.col("updated_at") <= ntz(BATCH_SPLIT), F.lit(1)).otherwise(F.lit(2))


def batch_ingested_at() -> Column:
    return (F.when(F.col("updated_at") <= ntz(BATCH_SPLIT), ntz(BATCH_INGESTED_AT[1]))
            .otherwise(ntz(BATCH_INGESTED_AT[2])))


def bronze_fixture(spark: SparkSession, sf_dir: str, schema_version: str = "v1") -> DataFrame:
    """Bronze as it stands after the two-batch replay: changelog + audit columns.

    ``_ingested_at`` is the fixed ingest instant of the producer batch each
    row belongs to.
    """
    return raw_orders(spark, sf_dir).withColumns({
        "_ingested_at": batch_ingested_at(),
        "_schema_version": F.lit(schema_version),
        "_source": F.lit(PIPELINE_ID),
    })


BATCH_INGESTED_SQL = (f"case when updated_at <= timestamp '{BATCH_SPLIT}' "
                      f"then timestamp '{BATCH_INGESTED_AT[1]}' "
                      f"else timestamp '{BATCH_INGESTED_AT[2]}' end")

BRONZE_SQL = f"""
select r.*, {BATCH_INGESTED_SQL} as _ingested_at,
       'v1' as _schema_version, '{PIPELINE_ID}' as _source
from ({RAW_ORDERS_SQL}) r
"""
