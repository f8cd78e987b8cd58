"""Upsert merge without a transactional table format (operators J1, J4, U2, U3).

``MERGE INTO`` is not available on plain Parquet, so the merge is spelled as
a relational plan: rows of the target whose key is not in the change set,
plus the change set (update-all for matched keys, insert-all for the rest).
The change set must hold at most one row per key (reduce it with
``latest_per_key`` first) — a key with several source rows is rejected by
transactional merges and would duplicate here.

Join strategy is left to Catalyst/AQE: a change set that is small at run time
becomes a broadcast hash anti-join (no shuffle of the target); a large one a
shuffled sort-merge anti-join on the key.  Skewed join partitions are split
by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_COPIES = "__copies"


def by_key(left: DataFrame, right: DataFrame, key: str | list[str], how: str) -> DataFrame:
    """Semi, anti or outer join on the key in which a null key matches a null key,
    as in a grouping; the right side's key columns are dropped."""
    keys = [key] if isinstance(key, str) else list(key)
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"__right_{k}" for k in keys])


def upsert(target: DataFrame, changes: DataFrame, key: str | list[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    kept = by_key(target, changes.select(*keys), keys, "left_anti")
    return kept.unionByName(changes, allowMissingColumns=True)


def merge_stats(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """How a merge would classify the change set: inserted / updated / unchanged.

    One left-outer join of the change set against the target's keys and a
    row hash (column-pruned: only key + hash cross the shuffle), then one
    grouped count.
    """
    cols = [c for c in changes.columns if c != key]
    # the hash skips nulls, so a null flag per column tells (null, x) from (x, null)
    row_hash = F.xxhash64(*[F.col(c) for c in cols], *[F.isnull(c) for c in cols])
    t = target.select(F.col(key), row_hash.alias("__t_hash"))
    c = changes.select(F.col(key), row_hash.alias("__c_hash"))
    j = by_key(c, t, key, "left_outer")
    kind = (F.when(F.col("__t_hash").isNull(), F.lit("inserted"))
            .when(F.col("__t_hash") == F.col("__c_hash"), F.lit("unchanged"))
            .otherwise(F.lit("updated")))
    return j.groupBy(kind.alias("action")).agg(F.count(F.lit(1)).alias("keys"))


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` not in ``b`` and of ``b`` not in ``a`` (multiset), tagged by side.

    Empty iff the two results are identical (stronger than equal counts).  Equal
    rows of both sides meet in one grouping, so either side is shuffled once.
    """
    rows = (a.withColumn(_COPIES, F.lit(1)).union(b.withColumn(_COPIES, F.lit(-1)))
            .groupBy(*a.columns).agg(F.sum(_COPIES).alias(_COPIES)).filter(F.col(_COPIES) != 0))
    side = F.when(F.col(_COPIES) > 0, "only_first").otherwise("only_second")
    return (rows.withColumns({"side": side, _COPIES: F.explode(F.sequence(F.lit(1), F.abs(_COPIES)))})
            .drop(_COPIES))
