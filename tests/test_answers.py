"""Seasons and events, variance of similar trips, elapsed time over clock
changes, and models from sums of products."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

import tripscope.operators as ops
from tripscope.functions import elapsed_seconds, in_zone, least_squares
from tripscope.operators import demand
from tripscope.plans.inspect import formatted_plan, has_node, read_schemas, scan_count
from tripscope.sinks import write_result
from tripscope.sources import read_trips

from helpers import make_trips, ts

RANGES = "season_name string, first_day date, last_day date"


def day(*args):
    return dt.date(*args)


# -- seasons ---------------------------------------------------------------------


def trips_on(spark, days, **more):
    return make_trips(
        spark,
        [{"tpep_pickup_datetime": ts(*d, 10), "tpep_dropoff_datetime": ts(*d, 10, m), **more} for d, m in days],
    )


def test_ranges_count_both_ends_and_overlaps(spark):
    trips = trips_on(
        spark,
        [((2021, 6, 30), 10), ((2021, 7, 1), 20), ((2021, 7, 3), 30), ((2021, 7, 3), 40), ((2021, 8, 31), 50), ((2021, 9, 1), 6)],
    )
    ranges = spark.createDataFrame(
        [
            ("summer", day(2021, 7, 1), day(2021, 8, 31)),
            ("fair", day(2021, 7, 3), day(2021, 7, 3)),
            ("long ago", day(1990, 1, 1), day(1990, 2, 1)),
            ("no day", day(2021, 7, 9), day(2021, 7, 2)),
            (None, day(2021, 6, 30), day(2021, 6, 30)),
            ("open", day(2021, 6, 30), None),
        ],
        RANGES,
    )
    rows = {r.season_name: (r.days, r.trips, r.avg_duration_min) for r in ops.trip_by_season(trips, ranges).collect()}
    assert rows == {None: (2, 2, 8.0), "summer": (3, 4, 35.0), "fair": (1, 2, 35.0)}


def test_a_day_counts_once_for_each_name(spark):
    trips = trips_on(spark, [((2021, 12, 24), 10), ((2021, 12, 31), 20), ((2022, 1, 1), 30)])
    ranges = spark.createDataFrame(
        [("feast", day(2021, 12, 20), day(2021, 12, 31)), ("feast", day(2021, 12, 31), day(2022, 1, 6)), ("all", day(1, 1, 1), day(9999, 12, 31))],
        RANGES,
    )
    rows = {r.season_name: (r.days, r.trips) for r in ops.tip_pct_by_season(trips, ranges).collect()}
    assert rows == {"feast": (3, 3), "all": (3, 3)}


def test_no_ranges_and_no_trips(spark):
    trips = trips_on(spark, [((2021, 12, 24), 10)])
    none = spark.createDataFrame([], RANGES)
    assert [tuple(r) for r in ops.trip_by_season(trips, none).collect()] == [(None, 1, 1, 10.0, 5.0)]
    assert ops.trip_by_season(make_trips(spark, [])).count() == 0
    assert ops.trip_by_season(make_trips(spark, [{"tpep_pickup_datetime": None}])).count() == 0


def test_many_ranges_equal_a_direct_count(spark):
    rng = np.random.default_rng(3)
    days = [dt.date(2020, 1, 1) + dt.timedelta(int(n)) for n in rng.integers(0, 800, 300)]
    trips = make_trips(spark, [{"tpep_pickup_datetime": dt.datetime(d.year, d.month, d.day, 9)} for d in days])
    spans = []
    for n in range(60):
        a = dt.date(2019, 11, 1) + dt.timedelta(int(rng.integers(0, 900)))
        spans.append((f"r{n % 40}", a, a + dt.timedelta(int(rng.integers(-3, 200)))))
    expect = {}
    for d in days:
        for name in {n for n, a, b in spans if a <= d <= b} or {None}:
            expect.setdefault(name, []).append(d)
    got = {r.season_name: (r.days, r.trips) for r in ops.trip_by_season(trips, spark.createDataFrame(spans, RANGES)).collect()}
    assert got == {k: (len(set(v)), len(v)) for k, v in expect.items()}


def test_season_join_has_equal_keys_and_no_trip_rows(spark, trips_small):
    plan = formatted_plan(ops.trip_by_season(trips_small))
    assert scan_count(plan) == 0  # the days are a checkpoint
    ranges = ops.season_ranges(spark.createDataFrame([(day(2021, 5, 5),)], "pickup_date date"))
    assert ranges.where("season_name = 'Year end'").count() == 2
    assert ranges.where("season_name = 'Year end' AND year(last_day) = year(first_day) + 1").count() == 2


# -- variance of similar trips -----------------------------------------------------


def test_variance_parts_add_up(spark, trips_small):
    for trips in (trips_small, trips_small.repartition(5)):
        for r in ops.speed_variance_by_od(trips).collect():
            parts = r.var_between_hours + r.var_between_bands + r.var_within
            assert math.isclose(parts, r.var_total, rel_tol=1e-9, abs_tol=1e-9)
            assert r.similar_share is None or 0 <= r.similar_share <= 1 + 1e-12


def test_variance_of_known_groups(spark):
    def trip(hour, miles, minutes):
        return {
            "tpep_pickup_datetime": ts(2021, 3, 1, hour),
            "tpep_dropoff_datetime": ts(2021, 3, 1, hour, minutes),
            "trip_distance": miles,
        }

    # Speeds: 10 and 20 mph at 8 h (one band), 40 mph at 9 h in each of two bands.
    short = {**trip(9, 3.0, 4), "tpep_dropoff_datetime": ts(2021, 3, 1, 9, 4, 30)}
    rows = [trip(8, 3.0, 18), trip(8, 3.0, 9), short, trip(9, 30.0, 45)]
    (r,) = ops.speed_variance_by_od(make_trips(spark, rows)).collect()
    assert (r.trips, r.avg_speed_mph) == (4, 27.5)
    assert math.isclose(r.var_within, 12.5) and math.isclose(r.var_between_bands, 0.0, abs_tol=1e-9)
    assert math.isclose(r.var_between_hours, 156.25) and math.isclose(r.var_total, 168.75)


def test_single_and_equal_trips_have_no_variance(spark):
    (r,) = ops.speed_variance_by_od(make_trips(spark, [{}])).collect()
    assert (r.trips, r.var_total, r.similar_share) == (1, 0.0, None)
    (r,) = ops.speed_variance_by_od(make_trips(spark, [{}, {}])).collect()
    assert (r.trips, r.var_total, r.similar_share) == (2, 0.0, None)
    assert ops.speed_variance_by_od(make_trips(spark, [{"tpep_dropoff_datetime": None}])).count() == 0


# -- elapsed time ------------------------------------------------------------------

NEW_YORK = "America/New_York"


@pytest.mark.parametrize(
    "start, end, wall, elapsed",
    [
        (ts(2021, 3, 14, 1, 50), ts(2021, 3, 14, 3, 10), 4800, 1200),  # clocks go forward at 2
        (ts(2021, 11, 7, 0, 50), ts(2021, 11, 7, 1, 10), 1200, 1200),  # first pass
        (ts(2021, 11, 7, 1, 50), ts(2021, 11, 7, 1, 10), -2400, 1200),  # second pass
        (ts(2021, 11, 7, 1, 10), ts(2021, 11, 7, 2, 10), 3600, 7200),  # clocks go back at 2
        (ts(2021, 6, 1, 1, 10), ts(2021, 6, 1, 2, 10), 3600, 3600),
        (ts(2021, 6, 1, 2, 10), ts(2021, 6, 1, 1, 10), -3600, -3600),  # a wrong row stays wrong
        (ts(2021, 11, 6, 12), ts(2021, 11, 8, 12), 172_800, 176_400),  # over the change, two days
        (None, ts(2021, 6, 1), None, None),
    ],
)
@pytest.mark.parametrize("session_zone", ["UTC", "Asia/Kolkata"])
def test_elapsed_time_over_clock_changes(spark, start, end, wall, elapsed, session_zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", session_zone)
        t = make_trips(spark, [{"tpep_pickup_datetime": start, "tpep_dropoff_datetime": end}])
        from tripscope.functions import duration_seconds

        r = t.select(duration_seconds().alias("wall"), elapsed_seconds(NEW_YORK).alias("elapsed")).first()
        assert tuple(r) == (wall, elapsed)
        zoned = in_zone(t, NEW_YORK)
        assert zoned.schema == t.schema
        assert zoned.select(duration_seconds()).first()[0] == elapsed
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_half_hour_change(spark):
    t = make_trips(spark, [{"tpep_pickup_datetime": ts(2021, 4, 4, 1, 50), "tpep_dropoff_datetime": ts(2021, 4, 4, 1, 35)}])
    assert t.select(elapsed_seconds("Australia/Lord_Howe")).first()[0] == 900


def test_default_durations_are_unchanged(spark):
    t = make_trips(spark, [{"tpep_pickup_datetime": ts(2021, 3, 14, 1, 50), "tpep_dropoff_datetime": ts(2021, 3, 14, 3, 10)}])
    assert ops.trip_by_hour(t).first().avg_duration_min == 80.0
    assert ops.trip_by_hour(in_zone(t, NEW_YORK)).first().avg_duration_min == 20.0
    r = ops.elapsed_by_month(t).first()
    assert (r.trips_over_change, r.avg_wall_min, r.avg_elapsed_min) == (1, 80.0, 20.0)


# -- models from sums of products ----------------------------------------------------


def solved(spark, rows, k):
    schema = ", ".join([f"x{i} double" for i in range(k)] + ["y double"])
    df = spark.createDataFrame([tuple(map(float, r)) for r in rows], schema)
    sums = df.agg(*least_squares.product_sums([F.col(f"x{i}") for i in range(k)], F.col("y")))
    return least_squares.solve(sums, k).first()


def test_solve_equals_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 4)) * [1, 10, 0.1, 3] + [0, 50, 2, -7]
    y = x @ [1.5, -0.25, 8.0, 0.0] + 3 + rng.normal(size=200)
    r = solved(spark, np.column_stack([x, y]), 4)
    beta, rss, _, _ = np.linalg.lstsq(np.column_stack([np.ones(200), x]), y, rcond=None)
    assert np.allclose([r[f"beta_{i}"] for i in range(5)], beta, rtol=1e-8)
    assert math.isclose(r.mse, rss[0] / 200, rel_tol=1e-8) and math.isclose(r.variance, y.var(), rel_tol=1e-9)


def test_constant_and_collinear_features_are_left_out(spark):
    rng = np.random.default_rng(6)
    a = rng.integers(0, 24, 300)
    b = rng.integers(1, 8, 300)
    y = 2.0 * a - b + 5 + rng.normal(size=300)
    want = np.linalg.lstsq(np.column_stack([np.ones(300), a, b]), y, rcond=None)[0]
    r = solved(spark, np.column_stack([a, np.full(300, 7), b, 3 * a - 2 * b + 1, y]), 4)
    assert np.allclose([r.beta_0, r.beta_1, r.beta_2, r.beta_3, r.beta_4], [want[0], want[1], 0, want[2], 0], atol=1e-8)


def test_degenerate_fits(spark):
    r = solved(spark, [(1, 2, 9)], 2)
    assert (r.beta_0, r.beta_1, r.beta_2, r.mse, r.variance) == (9.0, 0.0, 0.0, 0.0, 0.0)
    empty = spark.createDataFrame([], "x double, y double")
    r = least_squares.solve(empty.agg(*least_squares.product_sums([F.col("x")], F.col("y"))), 1).first()
    assert (r.beta_0, r.beta_1, r.mse) == (None, None, None)
    gaps = spark.createDataFrame([(1.0, None), (None, 4.0), (2.0, 6.0), (4.0, 10.0)], "x double, y double")
    r = least_squares.solve(gaps.agg(*least_squares.product_sums([F.col("x")], F.col("y"))), 1).first()
    assert (r.s_0_0, r.beta_0, r.beta_1) == (2.0, 2.0, 2.0)


def test_models_equal_the_estimator(trips_small):
    model = ops.fit_next_hour_model(trips_small)
    r = ops.demand_lr_next_hour(trips_small).first()
    assert np.allclose([r.coef_hour, r.coef_day_of_week, r.coef_month], model.coefficients.toArray(), rtol=1e-7, atol=1e-12)
    assert math.isclose(r.rmse, model.summary.rootMeanSquaredError, rel_tol=1e-9)
    model = ops.fit_hourly_total_model(trips_small)
    r = ops.demand_lr_hourly_total(trips_small).first()
    assert np.allclose([r.coef_hour, r.coef_day_of_week, r.coef_month, r.intercept], [*model.coefficients, model.intercept], rtol=1e-7)
    assert math.isclose(r.r2, model.summary.r2, rel_tol=1e-7)


def test_rolling_error_equals_refitting(spark):
    rng = np.random.default_rng(8)
    rows = []
    for n in range(2500):
        at = dt.datetime(2021, 1, 1) + dt.timedelta(hours=int(rng.integers(0, 24 * 200)))
        rows += [{"tpep_pickup_datetime": at}] * (1 + at.hour % 3)
    trips = make_trips(spark, rows)
    labels = demand._next_hour_table(trips).cache()
    features = ["hour", "day_of_week", "month"]
    assembled = VectorAssembler(inputCols=features, outputCol="features").transform(
        labels.select("hour_bucket", *[F.col(c).cast("double") for c in features], F.col("pickups_next_hour").cast("double").alias("y"))
    )
    rows = ops.demand_rolling_error(trips).collect()
    assert [(r.test_year, r.test_month) for r in rows] == [(2021, m) for m in range(2, 8)]
    for r in rows[:1] + rows[3:5]:
        edge = F.lit(dt.datetime(r.test_year, r.test_month, 1)).cast("timestamp_ntz")
        train = assembled.where(F.col("hour_bucket") < edge)
        test = assembled.where((F.col("hour_bucket") >= edge) & (F.col("hour_bucket") < edge + F.expr("INTERVAL 1 MONTH")))
        model = LinearRegression(labelCol="y", solver="normal").fit(train)
        off = [(p.y - p.prediction) ** 2 for p in model.transform(test).collect()]
        assert (r.train_hours, r.test_hours) == (train.count(), len(off))
        assert math.isclose(r.rmse, math.sqrt(sum(off) / len(off)), rel_tol=1e-7)
        assert math.isclose(r.train_rmse, model.summary.rootMeanSquaredError, rel_tol=1e-7)
    assert ops.demand_rolling_error(make_trips(spark, [])).count() == 0
    assert ops.demand_rolling_error(make_trips(spark, [{}])).count() == 0


def test_models_scan_once_without_a_join(trips_small):
    for fn in (ops.demand_lr_hourly_total, ops.demand_forecast):
        plan = formatted_plan(fn(trips_small))
        assert scan_count(plan) == 1 and "Join" not in plan
    result = ops.demand_lr_next_hour(trips_small)
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Join" not in plan and "ReusedExchange" in plan  # the last bucket comes from the hour counts


# -- latest trip -----------------------------------------------------------------


def test_latest_trip_reads_one_column_then_the_files_that_hold_it(spark, tmp_dir):
    import os

    months = [os.path.join(tmp_dir, f"m{m}") for m in (1, 2, 3)]
    write_result(make_trips(spark, [{"tpep_pickup_datetime": ts(2021, 1, d)} for d in range(1, 29)]), months[0])
    latest = {"tpep_pickup_datetime": ts(2021, 3, 9, 9)}
    write_result(make_trips(spark, [{**latest, "VendorID": 2, "tip_amount": 1.0}, {}]).coalesce(1), months[1])
    write_result(make_trips(spark, [{**latest, "VendorID": 2, "tip_amount": 9.0}, {**latest, "VendorID": 1}]).coalesce(1), months[2])
    trips = read_trips(spark, months)
    group = "latest-trip-test"
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = ops.latest_trip(trips)
        r = result.first()
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert (r.tpep_pickup_datetime, r.VendorID, r.tip_amount) == (ts(2021, 3, 9, 9), 2, 9.0)
    pickups = trips.select(F.col("_metadata.file_path").alias("f"), "tpep_pickup_datetime").groupBy("f").agg(F.max("tpep_pickup_datetime"))
    assert read_schemas(formatted_plan(pickups)) == [{"tpep_pickup_datetime"}]
    plan = formatted_plan(result)
    assert "m1" not in plan.split("file_path", 1)[1].split("]", 1)[0]
    # Files that do not hold the instant are not opened.
    scan = result._jdf.queryExecution().executedPlan().toString()
    assert "file_path" in scan
    empty = read_trips(spark, months).where("VendorID = 99")
    assert ops.latest_trip(empty).first().VendorID is None


def test_latest_trip_with_ties_over_more_files_than_are_named(spark, tmp_dir, monkeypatch):
    import os

    monkeypatch.setattr(demand, "LATEST_FILES", 2)
    write_result(make_trips(spark, [{"tip_amount": float(n)} for n in range(12)]).repartition(6), os.path.join(tmp_dir, "t"))
    assert ops.latest_trip(read_trips(spark, os.path.join(tmp_dir, "t"))).first().tip_amount == 11.0
