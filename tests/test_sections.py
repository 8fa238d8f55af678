"""Sections roll up shared cells: same values as the single analyses, one scan
of the trips for each cell table."""

import math

import pytest

from helpers import make_trips
from test_degenerate import _rows
from tripscope import analyses
from tripscope.plans import catalog


@pytest.mark.parametrize("section", [analyses.calendar_results, analyses.zone_results])
def test_section_values_equal_the_single_analyses(spark, trips_small, section):
    for trips in (trips_small, make_trips(spark, _rows()).repartition(3)):
        for key, result in section(trips).items():
            want = catalog.QUERY_FUNCTIONS[key](trips)
            keys = [c for c, t in want.dtypes if t != "double"]

            def table(df):
                return {tuple(r[c] for c in keys): [r[c] for c in want.columns if c not in keys] for r in df.collect()}

            got, expected = table(result), table(want)
            assert got.keys() == expected.keys(), key
            for k, values in expected.items():
                for a, b in zip(got[k], values):
                    assert a is b is None or math.isclose(a, b, rel_tol=1e-9), (key, k)


@pytest.mark.parametrize("section", [analyses.calendar_results, analyses.zone_results])
def test_results_read_the_cells_and_not_the_trips(trips_small, section):
    for key, result in section(trips_small).items():
        plan = result._jdf.queryExecution().optimizedPlan().toString()
        assert "lineitem" not in plan and "Relation" not in plan, key


def test_conformed_keys_are_catalogue_keys():
    assert catalog.CONFORMED_KEYS <= set(catalog.QUERY_FUNCTIONS)
