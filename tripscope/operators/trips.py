"""Trip duration and distance by calendar bucket.

Each function maps a conformed trips DataFrame to a small result DataFrame.
All measures of one key share a single ``agg``, so every result is one scan
and one partial/final hash aggregate: each map task ships at most one row per
key, which also absorbs any hot key before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripscope.functions import calendar_keys, day_of_month_of, elapsed_seconds, pickup, with_measures
from tripscope.operators.ordering import sort_bounded

CALENDAR_KEYS = ("hour", "day_of_week", "month")


def _by(trips: DataFrame, key: str) -> DataFrame:
    t = with_measures(trips, "trip_duration_min")
    return sort_bounded(
        t.groupBy(calendar_keys()[key].alias(key)).agg(
            F.avg("trip_duration_min").alias("avg_duration_min"),
            F.avg("trip_distance").alias("avg_distance"),
        ),
        key,
    )


def trip_by_hour(trips: DataFrame) -> DataFrame:
    """Average duration (minutes) and distance per hour of day."""
    return _by(trips, "hour")


def trip_by_day_of_week(trips: DataFrame) -> DataFrame:
    """Average duration (minutes) and distance per day of week (1 = Sunday)."""
    return _by(trips, "day_of_week")


def trip_by_month(trips: DataFrame) -> DataFrame:
    """Average duration (minutes) and distance per month of year."""
    return _by(trips, "month")


def duration_by_day_of_month(trips: DataFrame) -> DataFrame:
    """Average duration (minutes) per day of month, ascending."""
    t = with_measures(trips, "trip_duration_min")
    return sort_bounded(
        t.groupBy(day_of_month_of(pickup()).alias("day_of_month")).agg(
            F.avg("trip_duration_min").alias("avg_duration_min")
        ),
        "day_of_month",
    )


# Fixed value: the zone whose clocks the trips' times are taken to show.
TRIP_ZONE = "America/New_York"


def elapsed_by_month(trips: DataFrame, zone: str = TRIP_ZONE) -> DataFrame:
    """Average duration (minutes) per month on the wall clock and as time that
    passed in ``zone``, and how many trips the two differ for: those over a
    clock change."""
    apart = elapsed_seconds(zone)
    t = with_measures(trips, "trip_duration_s", extra={"month": calendar_keys()["month"], "elapsed_s": apart})
    return sort_bounded(
        t.groupBy("month").agg(
            F.count(F.lit(1)).alias("trips"),
            F.count_if(F.col("elapsed_s") != F.col("trip_duration_s")).alias("trips_over_change"),
            (F.avg("trip_duration_s") / 60.0).alias("avg_wall_min"),
            (F.avg("elapsed_s") / 60.0).alias("avg_elapsed_min"),
        ),
        "month",
    )


def trip_by_hour_dow_month(trips: DataFrame) -> DataFrame:
    """Average duration (seconds) and distance per passenger for each
    hour x day of week x month cell."""
    t = with_measures(
        trips, "trip_duration_s", "distance_per_passenger", extra=calendar_keys()
    )
    return sort_bounded(
        t.groupBy(*CALENDAR_KEYS).agg(
            F.avg("trip_duration_s").alias("avg_duration_s"),
            F.avg("distance_per_passenger").alias("avg_distance_per_passenger"),
        ),
        *CALENDAR_KEYS,
    )


def trip_calendar_sets(trips: DataFrame) -> DataFrame:
    """``trip_by_hour``, ``_day_of_week`` and ``_month`` from one scan.

    The trips are first reduced to their calendar cells (2,016 at most) with
    sums and counts; ``GROUPING SETS ((hour), (day_of_week), (month))`` then
    expands the cells, not the trips.  A stream allows one aggregate only, so
    there the sets expand the (new) trips.  ``grouping`` names the set a row
    belongs to; the other two keys are NULL in that row.
    """
    t = with_measures(trips, "trip_duration_min", extra=calendar_keys())
    keys = [F.col(k) for k in CALENDAR_KEYS]
    gid = F.grouping_id(*keys)
    if trips.isStreaming:
        rows, duration, distance = t, F.avg("trip_duration_min"), F.avg("trip_distance")
    else:
        rows = t.groupBy(*keys).agg(
            F.sum("trip_duration_min").alias("s_min"),
            F.count("trip_duration_min").alias("n_min"),
            F.sum("trip_distance").alias("s_mi"),
            F.count("trip_distance").alias("n_mi"),
        )
        duration = F.try_divide(F.sum("s_min"), F.sum("n_min"))
        distance = F.try_divide(F.sum("s_mi"), F.sum("n_mi"))
    result = (
        rows.groupingSets([[k] for k in keys], *keys)
        .agg(
            gid.alias("__gid"),
            duration.alias("avg_duration_min"),
            distance.alias("avg_distance"),
        )
        .select(
            # grouping_id bits: hour = 4, day_of_week = 2, month = 1 (1 = rolled up)
            F.when(F.col("__gid") == 3, "hour")
            .when(F.col("__gid") == 5, "day_of_week")
            .otherwise("month")
            .alias("grouping"),
            *CALENDAR_KEYS,
            "avg_duration_min",
            "avg_distance",
        )
    )
    return sort_bounded(result, "grouping", *CALENDAR_KEYS)
