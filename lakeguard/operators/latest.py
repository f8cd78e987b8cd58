"""Latest version per key (operator W1).

``row_number() = 1`` over ``partition by key order by <version order> desc``.
Catalyst rewrites this into a *partial* ``WindowGroupLimit`` before the shuffle
and a final one after it, so each map task forwards at most one row per key:
a key holding a third of all versions costs one row per input partition in
the shuffle, not a third of the data in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RN = "__version_rank"


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the greatest version of every key; ``order`` is compared descending
    column by column (nulls last) and should be total for a deterministic
    result."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def latest_sql(source_sql: str, key: str, order: Sequence[str]) -> str:
    """The same operator as SQL text (for oracles)."""
    order_by = ", ".join(f"{c} desc nulls last" for c in order)
    return (f"select * from ({source_sql}) "
            f"qualify row_number() over (partition by {key} order by {order_by}) = 1")
