"""High-water marks and the filters that use them (operators A1, P5, P6, J2).

The watermark is a one-row aggregate.  Passed as an uncorrelated scalar
subquery, Catalyst runs it once and pushes ``col > (subquery)`` into the
Parquet scan; a resolved literal also enables partition pruning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def high_watermark(df: DataFrame, col: str, alias: str | None = None) -> DataFrame:
    """Global max as a one-row DataFrame (partial max per task, one final row)."""
    return df.agg(F.max(col).alias(alias or f"max_{col}"))


# Lower bound used when the target is empty, so that "above the watermark"
# keeps every row and the watermark subquery is referenced only once.
_FLOOR = {"timestamp_ntz": "0001-01-01 00:00:00", "timestamp": "0001-01-01 00:00:00",
          "date": "0001-01-01"}


def watermark_value(target: DataFrame, col: str, floor: bool = True) -> Column:
    """The target's max of ``col`` as one scalar-subquery column; with
    ``floor`` an empty target yields the type's lowest value instead of NULL
    (a NULL watermark would select nothing)."""
    agg = F.max(col)
    if floor:
        dtype = target.schema[col].dataType
        agg = F.coalesce(agg, F.lit(_FLOOR[dtype.typeName()]).cast(dtype))
    return target.agg(agg.alias("__wm")).scalar()


def high_watermark_filter(df: DataFrame, col: str, watermark: Column | None,
                          strict: bool = True, on: Column | None = None) -> DataFrame:
    """Rows with ``on`` (default ``col``) above the watermark (``>`` if strict,
    else ``>=``).  ``None`` — no committed watermark, the target is empty —
    keeps every row, where the plain SQL comparison with a NULL max would
    keep none."""
    if watermark is None:
        return df
    value = on if on is not None else F.col(col)
    return df.filter(value > watermark if strict else value >= watermark)
