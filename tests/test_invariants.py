"""Relations that must hold between results."""

import pytest
from pyspark.sql import functions as F

import tripscope.operators as ops
from tripscope.plans.catalog import round_doubles


def test_zone_counts_sum_to_trips(trips_small):
    n = trips_small.count()
    assert ops.pickup_counts(trips_small).agg(F.sum("count")).first()[0] == n
    assert ops.dropoff_counts(trips_small).agg(F.sum("count")).first()[0] == n


def test_grouping_sets_equal_single_key_results(trips_small):
    sets = round_doubles(ops.trip_calendar_sets(trips_small)).collect()
    for key, fn in [("hour", ops.trip_by_hour), ("day_of_week", ops.trip_by_day_of_week), ("month", ops.trip_by_month)]:
        single = [tuple(r) for r in round_doubles(fn(trips_small)).collect()]
        from_sets = [(r[key], r.avg_duration_min, r.avg_distance) for r in sets if r.grouping == key]
        assert from_sets == single


def test_input_order_does_not_change_results(trips_small):
    shuffled = trips_small.repartition(7, F.rand(seed=3))
    for fn in (ops.tip_clamped_by_od, ops.speed_spread_by_od, ops.calendar_totals):
        a = sorted(map(tuple, round_doubles(fn(trips_small)).collect()), key=str)
        b = sorted(map(tuple, round_doubles(fn(shuffled)).collect()), key=str)
        assert a == b


def test_hourly_totals_add_up(trips_small):
    totals = ops.hourly_totals(trips_small).agg(F.sum("pickups"), F.sum("total_passengers")).first()
    expected = trips_small.agg(F.count(F.lit(1)), F.sum("passenger_count")).first()
    assert totals[0] == expected[0] and abs(totals[1] - expected[1]) < 1e-6


def test_next_hour_labels_cover_all_but_the_last_hour(trips_small):
    labels = ops.next_hour_labels(trips_small)
    ts = F.col("tpep_pickup_datetime")
    per_hour = trips_small.groupBy(F.date_format(ts, "yyyy-MM-dd HH")).count()
    assert labels.count() == per_hour.count() - 1
    total = labels.agg(F.sum("pickups")).first()[0]
    last = per_hour.orderBy(F.desc(per_hour.columns[0])).first()["count"]
    assert total == trips_small.count() - last


def test_the_whole_study_covers_the_catalogue(trips_small):
    from tripscope.analyses import SECTIONS, study
    from tripscope.plans.catalog import QUERY_FUNCTIONS

    assert set(study(trips_small)) == set(QUERY_FUNCTIONS) - {"source_profile"}
    assert set(study(trips_small, ["zones"])) == {"pickup_counts", "dropoff_counts", "top_pickups", "top_dropoffs"}
    assert "fares" in SECTIONS
    with pytest.raises(ValueError, match="no such sections"):
        study(trips_small, ["fares", "weather"])


def test_a_study_builds_each_cell_table_once(trips_small, monkeypatch):
    from tripscope import analyses

    built = []
    whole = analyses._cells
    monkeypatch.setattr(analyses, "_cells", lambda *a: built.append(1) or whole(*a))
    analyses.study(trips_small, ["trips", "zones", "tips", "traffic"])
    assert len(built) == 2
    analyses.study(trips_small, ["fares"])
    assert len(built) == 3


def test_rounding_scales_the_binary_value(spark):
    import duckdb

    from tripscope.plans.catalog import round_half_away

    values = [16.157812499999998, 0.1234565, -2.5e-6, 2.675, 1e-7, -16.157812499999998, 123456.0]
    spark_rounded = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(round_half_away(F.col("x"), 6)).collect()]
    duck_rounded = [duckdb.sql(f"SELECT round({v!r}::DOUBLE, 6)").fetchall()[0][0] for v in values]
    assert spark_rounded == duck_rounded


def test_trip_files_give_the_same_results_as_the_fixture(spark, trips_small, tmp_dir):
    import os

    from tripscope.plans.catalog import QUERY_FUNCTIONS
    from tripscope.sinks import write_result
    from tripscope.sources import read_trips

    path = os.path.join(tmp_dir, "trips")
    write_result(trips_small.repartition(4), path)
    from_files = read_trips(spark, path)
    import pytest

    def rows(df):
        key = lambda r: tuple(str(v) for v in r if not isinstance(v, float))
        return sorted((tuple(r) for r in df.collect()), key=key)

    for key, fn in QUERY_FUNCTIONS.items():
        a, b = rows(fn(trips_small)), rows(fn(from_files))
        assert len(a) == len(b), key
        for ra, rb in zip(a, b):
            for va, vb in zip(ra, rb):
                # four files add in another order than one: equal to rounding
                if isinstance(va, float):
                    assert vb == pytest.approx(va, rel=1e-9, abs=1e-12), key
                else:
                    assert va == vb, key
