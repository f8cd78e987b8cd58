"""Type-name normalisation for schema contracts (operator F1).

A contract type name is lower-cased and then looked up once in the alias table
below; names not in the table are kept (lower-cased).  The lookup is exact and
not transitive: ``varchar(10)`` or ``array<int>`` are kept verbatim.  With
``deep=True`` nested type strings are normalised element by element instead.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The type aliases the contract gate treats as equal.  They must
# stay exactly these eight pairs for verdicts to match.
TYPE_ALIASES: dict[str, str] = {
    "int": "integer",
    "long": "integer",
    "bigint": "integer",
    "float": "double",
    "bool": "boolean",
    "str": "string",
    "varchar": "string",
    "timestamp_ntz": "timestamp",
}

_TOKEN = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def normalize_type_name(name: str, deep: bool = False) -> str:
    """Canonical name of one type string (driver-side helper for metadata)."""
    lowered = name.lower()
    if not deep:
        return TYPE_ALIASES.get(lowered, lowered)
    # deep: rewrite every type token inside array<...>/map<...>/struct<...>;
    # struct field names (followed by ':') are left alone.
    out, pos = [], 0
    for m in _TOKEN.finditer(lowered):
        out.append(lowered[pos:m.start()])
        token = m.group(0)
        is_field_name = lowered[m.end():m.end() + 1] == ":"
        out.append(token if is_field_name else TYPE_ALIASES.get(token, token))
        pos = m.end()
    out.append(lowered[pos:])
    return "".join(out)


def normalize_type(col: Column | str) -> Column:
    """Column expression: canonical type name for a column of type names.

    Written as one CASE over the lowered name so it stays a codegen'd JVM
    expression (no Python in the plan).
    """
    lowered = F.lower(F.col(col) if isinstance(col, str) else col)
    expr = None
    for alias, canonical in TYPE_ALIASES.items():
        cond = lowered == F.lit(alias)
        expr = F.when(cond, F.lit(canonical)) if expr is None else expr.when(cond, F.lit(canonical))
    return expr.otherwise(lowered)


def type_name(dtype: T.DataType) -> str:
    """Raw type name of a Spark type as the gate sees it."""
    return dtype.simpleString()


def normalize_sql(expr: str) -> str:
    """The same normalisation as an ANSI SQL CASE (used by oracle queries)."""
    whens = " ".join(f"WHEN '{a}' THEN '{c}'" for a, c in TYPE_ALIASES.items())
    return f"(CASE lower({expr}) {whens} ELSE lower({expr}) END)"
