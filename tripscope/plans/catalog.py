"""The named analyses: one key per result table.

Each entry maps a key to a function of a trips DataFrame.  ``queries()``
binds them to the test tables (``lineitem`` mapped to trips) and rounds the
double columns, so results from engines that add in a different order can be
compared value for value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tripscope.operators as ops
from tripscope.schema import conform
from tripscope.sources import source_profile, trips_from_lineitem

TripQuery = Callable[[DataFrame], DataFrame]

QUERY_FUNCTIONS: dict[str, TripQuery] = {
    # sources
    "source_profile": source_profile,
    # trip duration and distance
    "trip_by_hour": ops.trip_by_hour,
    "trip_by_day_of_week": ops.trip_by_day_of_week,
    "trip_by_month": ops.trip_by_month,
    "duration_by_day_of_month": ops.duration_by_day_of_month,
    "elapsed_by_month": ops.elapsed_by_month,
    "trip_by_hour_dow_month": ops.trip_by_hour_dow_month,
    "trip_calendar_sets": ops.trip_calendar_sets,
    # popular locations
    "pickup_counts": ops.pickup_counts,
    "dropoff_counts": ops.dropoff_counts,
    "top_pickups": ops.top_pickups,
    "top_dropoffs": ops.top_dropoffs,
    # tips
    "tip_pct_by_hour": ops.tip_pct_by_hour,
    "tip_pct_by_day_of_week": ops.tip_pct_by_day_of_week,
    "tip_pct_by_month": ops.tip_pct_by_month,
    "tip_ratio_by_pickup": ops.tip_ratio_by_pickup,
    "tip_amount_by_hour": ops.tip_amount_by_hour,
    "tip_amount_by_payment": ops.tip_amount_by_payment,
    "tip_clamped_by_od": ops.tip_clamped_by_od,
    "tip_clamped_by_hour_dow_month": ops.tip_clamped_by_hour_dow_month,
    "tip_clamped_by_payment": ops.tip_clamped_by_payment,
    # fares
    "fare_by_od": ops.fare_by_od,
    "fare_by_passengers": ops.fare_by_passengers,
    "fare_distance_corr": ops.fare_distance_corr,
    "fare_per_mile_distance_corr": ops.fare_per_mile_distance_corr,
    # traffic speed
    "speed_by_hour": ops.speed_by_hour,
    "speed_by_day_of_week": ops.speed_by_day_of_week,
    "speed_by_month": ops.speed_by_month,
    "speed_by_pickup_hour": ops.speed_by_pickup_hour,
    "speed_by_od_hour_dow_month": ops.speed_by_od_hour_dow_month,
    # questions of the brief
    "tip_distance_corr": ops.tip_distance_corr,
    "fare_passenger_corr": ops.fare_passenger_corr,
    "tip_pct_by_year_week": ops.tip_pct_by_year_week,
    "tip_pct_by_holiday": ops.tip_pct_by_holiday,
    "trip_by_holiday": ops.trip_by_holiday,
    "tip_pct_by_season": ops.tip_pct_by_season,
    "trip_by_season": ops.trip_by_season,
    "speed_spread_by_od": ops.speed_spread_by_od,
    "speed_variance_by_od": ops.speed_variance_by_od,
    "speed_by_od_week": ops.speed_by_od_week,
    # demand
    "demand_lr_passengers": ops.demand_lr_passengers,
    "next_hour_labels": ops.next_hour_labels,
    "demand_lr_next_hour": ops.demand_lr_next_hour,
    "demand_rolling_error": ops.demand_rolling_error,
    "hourly_totals": ops.hourly_totals,
    "calendar_totals": ops.calendar_totals,
    "demand_lr_hourly_total": ops.demand_lr_hourly_total,
    "latest_trip": ops.latest_trip,
    "demand_forecast": ops.demand_forecast,
}

# Decimal places kept per double column when comparing engines.  Averages
# keep 6 and money totals are kept to the cent.  Correlations, slopes and R^2
# (small numbers that both engines compute the same way) keep 9; intercepts,
# RMSE and predictions of the three-feature models (solved differently by
# the two engines) keep 6.
DEFAULT_DIGITS = 6
DIGITS = {
    "total_tip_amount": 2,
    # Variances of speeds reach 10^8: nine digits before the point.
    "var_total": 2,
    "var_between_hours": 2,
    "var_between_bands": 2,
    "var_within": 2,
    "correlation": 9,
    "coefficient": 9,
    "r2": 9,
    "coef_hour": 9,
    "coef_day_of_week": 9,
    "coef_month": 9,
}


def round_half_away(col: Column, digits: int) -> Column:
    """``col`` rounded to ``digits`` places by scaling its binary value:
    ``round(x * 10^d) / 10^d``, halves away from zero.

    ``F.round(x, d)`` instead rounds the shortest decimal rendering of ``x``
    (16.157812499999998 renders as "16.1578125" and goes up), while SQL
    engines commonly scale the binary value (and go down).  Rounding the
    scaled value, an integer plus an exact half at worst, gives the same
    result both ways, so equal doubles always round equally.
    """
    scale = F.lit(10.0**digits)
    return F.round(col * scale, 0) / scale


def round_doubles(df: DataFrame) -> DataFrame:
    """Round every double column to its digits (a projection; order kept)."""
    cols = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            col = round_half_away(col, DIGITS.get(field.name, DEFAULT_DIGITS)).alias(field.name)
        cols.append(col)
    return df.select(*cols)


# Keys that go through ``conform``, the path of every real file: one a section.
CONFORMED_KEYS = frozenset(
    {"source_profile", "trip_by_hour", "pickup_counts", "tip_pct_by_hour", "fare_by_passengers", "speed_by_hour", "hourly_totals"}
)


def as_read(trips: DataFrame) -> DataFrame:
    """``trips`` as drifting files hold them (names in lower case, ids as
    doubles), conformed again."""
    raw = [
        (F.col(f.name).cast("double") if isinstance(f.dataType, T.LongType) else F.col(f.name)).alias(f.name.lower())
        for f in trips.schema.fields
    ]
    return conform(trips.select(*raw))


def _bind(fn: TripQuery, key: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        trips = trips_from_lineitem(spark, sf_dir)
        return round_doubles(fn(as_read(trips) if key in CONFORMED_KEYS else trips))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every key bound to the test tables under a scale-factor folder."""
    return {key: _bind(fn, key) for key, fn in QUERY_FUNCTIONS.items()}
