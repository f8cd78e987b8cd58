"""Producer batches in the shapes the contract gate must tell apart.

Each batch is the whole order changelog (``raw_orders``) in one upstream
shape: the v1 baseline, v2 with an added nullable ``delivery_partner``, v3
without ``customer_id``, a type change, alias-only type differences and a
rename.  They are real DataFrames over the provided tables; the gate only
reads their schemas, the ingest writes their rows.

``SCENARIO_SQL`` holds the same batches as SQL over the provided tables so an
SQL engine can describe the identical shapes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeguard.sources.fixture import RAW_ORDERS_SQL, raw_orders

V1 = ["order_id", "customer_id", "product_id", "quantity", "unit_price",
      "status", "created_at", "updated_at"]


def _partner() -> F.Column:
    return F.concat(F.lit("partner-"), (F.pmod(F.col("l_suppkey"), F.lit(5)) + 1).cast("string"))


def shapes(r: DataFrame) -> dict[str, DataFrame]:
    """The batches as projections of the changelog ``r``."""
    return {
        "baseline": r.select(*V1),
        "non_breaking": r.select(*V1, _partner().alias("delivery_partner")),
        "breaking": r.select(*[c for c in V1 if c != "customer_id"]),
        "type_change": r.select(*[F.col(c).cast("string").alias(c) if c == "quantity" else c
                                  for c in V1]),
        "alias_types": r.select(*[F.col(c).cast("bigint").alias(c) if c == "quantity" else c
                                  for c in V1]),
        "rename": r.select(*[F.col(c).alias("cust_id") if c == "customer_id" else c for c in V1]),
    }


SCENARIOS = ["baseline", "non_breaking", "breaking", "type_change", "alias_types", "rename"]
# The schema_version each producer claims for its batch.
SCENARIO_VERSION = {"baseline": "v1", "non_breaking": "v2", "breaking": "v3",
                    "type_change": "v1", "alias_types": "v1", "rename": "v1"}
# Fixed, data-independent evaluation instants of the replay (one per batch).
SCENARIO_EVALUATED_AT = {name: f"2001-12-{i + 3:02d} 06:00:00" for i, name in enumerate(SCENARIOS)}


def scenario_batches(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return shapes(raw_orders(spark, sf_dir))


_V1_SQL = ", ".join(V1)
SCENARIO_SQL = {
    "baseline": f"select {_V1_SQL} from ({RAW_ORDERS_SQL}) r",
    "non_breaking": f"select {_V1_SQL}, 'partner-' || cast(l_suppkey % 5 + 1 as varchar) "
                    f"as delivery_partner from ({RAW_ORDERS_SQL}) r",
    "breaking": "select " + ", ".join(c for c in V1 if c != "customer_id")
                + f" from ({RAW_ORDERS_SQL}) r",
    "type_change": "select " + ", ".join("cast(quantity as varchar) as quantity" if c == "quantity"
                                         else c for c in V1) + f" from ({RAW_ORDERS_SQL}) r",
    "alias_types": "select " + ", ".join("cast(quantity as bigint) as quantity" if c == "quantity"
                                         else c for c in V1) + f" from ({RAW_ORDERS_SQL}) r",
    "rename": "select " + ", ".join("customer_id as cust_id" if c == "customer_id" else c
                                    for c in V1) + f" from ({RAW_ORDERS_SQL}) r",
}
