"""Every registered query equals its DuckDB oracle at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as entry
from helpers import SF_ORACLE
from oracle_check import compare, duckdb_connection

from tripscope.plans import catalog

KEYS = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(entry.queries())
    assert set(KEYS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    ok, msg = compare(spark, con, key, entry.queries()[key], entry.oracle_sql()[key], SF_ORACLE)
    assert ok, msg


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 24 + 7 + 12
    assert df.columns == ["grouping", "hour", "day_of_week", "month", "avg_duration_min", "avg_distance"]
