"""One hand-made case per rule: division, NULL, clamp, calendar codings."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

import tripscope.operators as ops
from tripscope.functions import us_federal_holiday
from tripscope.plans.catalog import QUERY_FUNCTIONS

from helpers import make_trips, ts


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def test_zero_and_null_passengers_drop_out_of_per_passenger_average(spark):
    t = make_trips(
        spark,
        [
            {"trip_distance": 6.0, "passenger_count": 2.0},
            {"trip_distance": 10.0, "passenger_count": 0.0},
            {"trip_distance": 10.0, "passenger_count": None},
        ],
    )
    assert one(ops.trip_by_hour_dow_month(t)).avg_distance_per_passenger == 3.0


def test_zero_total_gives_null_tip_percentage_and_clamp_maps_it_to_zero(spark):
    t = make_trips(
        spark,
        [
            {"tip_amount": 5.0, "total_amount": 25.0},  # 20 %
            {"tip_amount": 1.0, "total_amount": 0.0},  # NULL (divisor 0)
            {"tip_amount": 30.0, "total_amount": 20.0},  # 150 % -> clamped 0
            {"tip_amount": -2.0, "total_amount": 20.0},  # -10 % stays
        ],
    )
    assert one(ops.tip_pct_by_hour(t)).avg_tip_percentage == pytest.approx((20 + 150 - 10) / 3)
    clamped = one(ops.tip_clamped_by_payment(t))
    assert clamped.avg_tip_percentage == pytest.approx((20 + 0 + 0 - 10) / 4)
    assert clamped.total_tip_amount == pytest.approx(34.0)


def test_ratio_of_averages_with_zero_total_is_null(spark):
    t = make_trips(spark, [{"tip_amount": 1.0, "total_amount": 0.0}])
    assert one(ops.tip_ratio_by_pickup(t)).tip_percentage is None


def test_zero_duration_has_no_speed(spark):
    t = make_trips(
        spark,
        [
            {"trip_distance": 10.0},  # 30 minutes -> 20 mph
            {"tpep_dropoff_datetime": ts(2021, 3, 1, 10, 0, 0)},  # 0 s -> NULL
        ],
    )
    assert one(ops.speed_by_hour(t)).avg_speed_mph == pytest.approx(20.0)


def test_duration_is_whole_seconds_and_minutes(spark):
    t = make_trips(spark, [{"tpep_dropoff_datetime": ts(2021, 3, 1, 10, 1, 30)}])
    assert one(ops.trip_by_hour(t)).avg_duration_min == pytest.approx(1.5)
    assert one(ops.trip_by_hour_dow_month(t)).avg_duration_s == 90.0


def test_zero_distance_has_no_fare_per_mile(spark):
    rows = [
        {"fare_amount": 10.0, "trip_distance": 1.0},
        {"fare_amount": 12.0, "trip_distance": 2.0},
        {"fare_amount": 20.0, "trip_distance": 4.0},
        {"fare_amount": 7.0, "trip_distance": 0.0},
    ]
    t = make_trips(spark, rows)
    got = one(ops.fare_per_mile_distance_corr(t)).correlation
    xs = [r["fare_amount"] / r["trip_distance"] for r in rows[:3]]
    ys = [r["trip_distance"] for r in rows[:3]]
    assert got == pytest.approx(_pearson(xs, ys))


def _pearson(xs, ys):
    n = len(xs)
    mx, my = sum(xs) / n, sum(ys) / n
    sxy = sum((x - mx) * (y - my) for x, y in zip(xs, ys))
    sxx = sum((x - mx) ** 2 for x in xs)
    syy = sum((y - my) ** 2 for y in ys)
    return sxy / math.sqrt(sxx * syy)


def test_correlation_leaves_out_null_pairs(spark):
    rows = [
        {"passenger_count": 1.0, "fare_amount": 10.0},
        {"passenger_count": 2.0, "fare_amount": 13.0},
        {"passenger_count": 3.0, "fare_amount": 19.0},
        {"passenger_count": None, "fare_amount": 100.0},
    ]
    got = one(ops.fare_passenger_corr(make_trips(spark, rows))).correlation
    assert got == pytest.approx(_pearson([1, 2, 3], [10, 13, 19]))


def test_null_passenger_count_is_its_own_fare_group(spark):
    t = make_trips(spark, [{"passenger_count": None, "fare_amount": 8.0}, {"fare_amount": 4.0}])
    got = {r.passenger_count: r.avg_fare for r in ops.fare_by_passengers(t).collect()}
    assert got == {None: 8.0, 1.0: 4.0}


def test_day_of_week_is_sunday_one(spark):
    t = make_trips(spark, [{"tpep_pickup_datetime": ts(2021, 3, 7, 9), "tpep_dropoff_datetime": ts(2021, 3, 7, 10)}])
    assert one(ops.trip_by_day_of_week(t)).day_of_week == 1


def test_iso_week_at_the_turn_of_the_year(spark):
    t = make_trips(
        spark,
        [
            {"tpep_pickup_datetime": ts(2021, 1, 3, 12), "tpep_dropoff_datetime": ts(2021, 1, 3, 13)},
            {"tpep_pickup_datetime": ts(2021, 1, 4, 12), "tpep_dropoff_datetime": ts(2021, 1, 4, 13)},
        ],
    )
    got = [(r.iso_year, r.iso_week) for r in ops.tip_pct_by_year_week(t).collect()]
    assert got == [(2020, 53), (2021, 1)]


def test_next_hour_labels_across_gaps_and_last_bucket(spark):
    times = [(10, 5), (10, 50), (11, 0), (13, 1), (13, 2), (13, 59), (14, 30)]
    t = make_trips(
        spark,
        [
            {"tpep_pickup_datetime": ts(2021, 3, 1, h, m), "tpep_dropoff_datetime": ts(2021, 3, 1, h, m) + dt.timedelta(minutes=5)}
            for h, m in times
        ],
    )
    got = [(r.hour_bucket.hour, r.pickups, r.pickups_next_hour) for r in ops.next_hour_labels(t).collect()]
    # 12:00 has no pickups: 11 -> 0 next; 14:00 is the last bucket: dropped.
    assert got == [(10, 2, 1), (11, 1, 0), (13, 3, 1)]


def test_top_ten_breaks_count_ties_by_zone(spark):
    t = make_trips(spark, [{"PULocationID": z} for z in range(12, 0, -1)] + [{"PULocationID": 7}])
    got = [r.PULocationID for r in ops.top_pickups(t).collect()]
    assert got == [7, 1, 2, 3, 4, 5, 6, 8, 9, 10]


FIXED_QUERY_KEYS = [k for k in QUERY_FUNCTIONS if not k.startswith("demand_lr") and k != "demand_forecast"]


@pytest.mark.parametrize("key", FIXED_QUERY_KEYS)
def test_empty_input(spark, key):
    t = make_trips(spark, [{}]).limit(0)
    rows = QUERY_FUNCTIONS[key](t).collect()
    assert len(rows) <= 12  # source_profile: one row per column; aggregates: none or one


HOLIDAYS_2021 = {
    dt.date(2021, 1, 1): "New Year's Day",
    dt.date(2021, 1, 18): "Martin Luther King Jr. Day",
    dt.date(2021, 2, 15): "Washington's Birthday",
    dt.date(2021, 5, 31): "Memorial Day",
    dt.date(2021, 6, 19): "Juneteenth",
    dt.date(2021, 7, 4): "Independence Day",
    dt.date(2021, 9, 6): "Labor Day",
    dt.date(2021, 10, 11): "Columbus Day",
    dt.date(2021, 11, 11): "Veterans Day",
    dt.date(2021, 11, 25): "Thanksgiving Day",
    dt.date(2021, 12, 25): "Christmas Day",
}


def test_federal_holiday_rule_for_2021(spark):
    days = spark.range(365).select(F.date_add(F.lit(dt.date(2021, 1, 1)), F.col("id").cast("int")).alias("d"))
    got = {r.d: r.name for r in days.select("d", us_federal_holiday(F.col("d")).alias("name")).where("name IS NOT NULL").collect()}
    assert got == HOLIDAYS_2021


def test_juneteenth_starts_in_2021(spark):
    d = spark.range(1).select(us_federal_holiday(F.lit(dt.date(2020, 6, 19))).alias("n"))
    assert one(d).n is None


def test_caller_holiday_calendar(spark):
    t = make_trips(
        spark,
        [
            {"tpep_pickup_datetime": ts(2021, 3, 1, 9), "tip_amount": 10.0, "total_amount": 20.0},
            {"tpep_pickup_datetime": ts(2021, 3, 2, 9), "tip_amount": 2.0, "total_amount": 20.0},
            {"tpep_pickup_datetime": ts(2021, 3, 2, 11), "tip_amount": 4.0, "total_amount": 20.0},
        ],
    )
    holidays = spark.createDataFrame([(dt.date(2021, 3, 1), "Festival"), (dt.date(2021, 3, 1), "Festival")], "holiday_date date, holiday_name string")
    got = {r.holiday_name: (r.days, r.trips, r.avg_tip_percentage) for r in ops.tip_pct_by_holiday(t, holidays).collect()}
    assert got == {"Festival": (1, 1, 50.0), None: (1, 2, pytest.approx(15.0))}


def test_results_do_not_depend_on_the_session_time_zone(spark):
    # 2021-03-14 02:00 does not exist in New York (DST starts); wall-clock
    # trips are still 30 minutes long and keep their hour.
    rows = [
        {"tpep_pickup_datetime": ts(2021, 3, 14, 1, 45), "tpep_dropoff_datetime": ts(2021, 3, 14, 2, 15)},
        {"tpep_pickup_datetime": ts(2021, 3, 14, 2, 10), "tpep_dropoff_datetime": ts(2021, 3, 14, 2, 40)},
    ]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        results = {}
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            t = make_trips(spark, rows)
            results[zone] = (
                [tuple(r) for r in ops.trip_by_hour(t).collect()],
                [(r.hour_bucket, r.pickups_next_hour) for r in ops.next_hour_labels(t).collect()],
            )
        assert results["UTC"] == results["America/New_York"]
        assert [r[0] for r in results["UTC"][0]] == [1, 2]
        assert all(r[1] == 30.0 for r in results["UTC"][0])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_latest_trip_is_the_whole_row_and_ties_are_deterministic(spark):
    rows = [
        {"PULocationID": 3, "tpep_pickup_datetime": ts(2021, 5, 1, 9), "tpep_dropoff_datetime": ts(2021, 5, 1, 9, 30)},
        {"PULocationID": 5, "tpep_pickup_datetime": ts(2021, 5, 1, 9), "tpep_dropoff_datetime": ts(2021, 5, 1, 9, 20)},
        {"PULocationID": 9, "tpep_pickup_datetime": ts(2021, 4, 1, 9), "tpep_dropoff_datetime": ts(2021, 4, 1, 9, 20)},
    ]
    for order in (rows, rows[::-1]):
        got = one(ops.latest_trip(make_trips(spark, order)))
        # tie on the pickup: the next column in schema order decides (the
        # later dropoff, 09:30, zone 3), whatever the input order
        assert (got.PULocationID, got.tpep_dropoff_datetime) == (3, ts(2021, 5, 1, 9, 30))
        assert got.fare_amount == 20.0



def test_correlation_with_a_constant_side_is_null_not_an_error(spark):
    t = make_trips(spark, [{"trip_distance": float(i)} for i in range(5)])  # fares all equal
    assert one(ops.fare_distance_corr(t)).correlation is None
    assert one(ops.fare_passenger_corr(t)).correlation is None
    assert one(ops.tip_distance_corr(t)).correlation is None
    single = make_trips(spark, [{}])
    assert one(ops.fare_per_mile_distance_corr(single)).correlation is None


DEGENERATE = {
    "empty": [],
    "single_trip": [{}],
    "all_equal": [{} for _ in range(6)],
    "no_usable_measures": [
        {"passenger_count": None, "total_amount": 0.0, "trip_distance": 0.0, "tpep_dropoff_datetime": ts(2021, 3, 1, 10)}
        for _ in range(4)
    ],
    "sparse_hours": [
        {"tpep_pickup_datetime": ts(2021, 3, 1, h), "tpep_dropoff_datetime": ts(2021, 3, 1, h, 20), "passenger_count": float(h)}
        for h in (1, 2, 5)
    ],
}


@pytest.mark.parametrize("case", sorted(DEGENERATE))
def test_every_query_survives_degenerate_input(spark, case):
    # Under ANSI a stray division by zero fails the whole job; a fit on no
    # rows raises.  Each query must instead return NULLs where undefined.
    rows = DEGENERATE[case]
    t = make_trips(spark, rows or [{}])
    if not rows:
        t = t.limit(0)
    for key, fn in QUERY_FUNCTIONS.items():
        fn(t).collect()


def test_models_without_training_rows_are_null(spark):
    t = make_trips(spark, [{}])  # one hour bucket: no next-hour label
    row = one(ops.demand_lr_next_hour(t))
    assert row.coef_hour is None and row.prediction is None
    forecast = ops.demand_forecast(make_trips(spark, [{"passenger_count": None}])).collect()
    assert len(forecast) == 3 and all(r.predicted_total_passengers is None for r in forecast)
