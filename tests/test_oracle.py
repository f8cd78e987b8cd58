"""Every registered query against its DuckDB oracle on the smallest data."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

from conftest import SF_SMALL

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from lakeguard.queries import QUERIES  # noqa: E402


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["order_date", "total_orders", "gross_revenue", "avg_order_value",
                          "delivered_orders", "cancelled_orders"]
    assert df.count() > 0


def test_every_library_query_has_an_oracle():
    """Training-data queries without one are held against brute force in their own tests."""
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) <= set(o)


def test_read_only_lakes_are_made_once_and_again_when_gone(spark):
    from lakeguard.plans import catalog
    from lakeguard.plans import lake as lk
    first = catalog._lake(spark, SF_SMALL, None)
    assert catalog._lake(spark, SF_SMALL, None) == first
    lk.delete_path(spark, first.root)
    again = catalog._lake(spark, SF_SMALL, None)
    assert again != first and lk.exists(spark, again.bronze)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(spark, name):
    from oracle_check import compare
    rec = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert rec.get("ok") is not False, rec
