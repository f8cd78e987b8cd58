"""Order-independent money aggregates.

Money columns are doubles (as in the source contract).  A double sum depends
on the order rows arrive in, which differs between runs, executors and
engines; summing through ``DECIMAL(28,6)`` makes the result exact and
identical everywhere.  The decimal is cast back to double at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,6)"
REVENUE = "decimal(38,6)"   # a stored sum of such amounts


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def money_sum(col: Column | str) -> Column:
    return F.sum(_c(col).cast(MONEY)).cast("double")


def money_avg(col: Column | str) -> Column:
    """Mean per row: exact decimal sum over the count of non-null values."""
    return money_sum(col) / F.count(_c(col))
