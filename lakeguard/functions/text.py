"""Text renderings used by the observability logs.

The logs keep typed columns; these helpers add the human-readable text the
reference's logs carry (Python ``str(list)`` style lists, ISO timestamps).
All are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def list_text(arr: Column | str) -> Column:
    """``array<string>`` -> ``['a', 'b']`` (``[]`` when empty)."""
    quoted = F.transform(_c(arr), lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def type_changes_text(arr: Column | str) -> Column:
    """``array<struct<column,expected,actual>>`` -> the dict-list text form."""
    item = lambda s: F.concat(
        F.lit("{'column': '"), s["column"],
        F.lit("', 'expected': '"), s["expected"],
        F.lit("', 'actual': '"), s["actual"], F.lit("'}"))
    return F.concat(F.lit("["), F.array_join(F.transform(_c(arr), item), ", "), F.lit("]"))


def iso_text(ts: Column | str) -> Column:
    """``timestamp_ntz`` (UTC by convention) -> ``2001-12-01T00:00:00``."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss")


def ordered_names(pairs: Column) -> Column:
    """``array<struct<ordinal,name>>`` -> names in ordinal order."""
    return F.transform(F.array_sort(pairs), lambda s: s["name"])
