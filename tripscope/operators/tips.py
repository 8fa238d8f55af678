"""Tip analyses.

Two tip percentages exist and are kept apart:

* per trip, ``tip / total * 100`` (NULL when the total is 0), averaged per
  group -- unclamped in the ``tip_pct_*`` results, clamped (values > 100 and
  NULL become 0) in the ``tip_clamped_*`` results;
* per group, the ratio of averages ``avg(tip) / avg(total) * 100``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripscope.functions import (
    calendar_keys,
    iso_week_of,
    iso_year_of,
    pearson,
    pickup,
    us_federal_holiday,
    with_measures,
)
from tripscope.operators.ordering import sort_bounded
from tripscope.operators.trips import CALENDAR_KEYS


def _tip_pct_by(trips: DataFrame, key: str) -> DataFrame:
    t = with_measures(trips, "tip_percentage")
    return (
        t.groupBy(calendar_keys()[key].alias(key))
        .agg(F.avg("tip_percentage").alias("avg_tip_percentage"))
        .transform(sort_bounded, key)
    )


def tip_pct_by_hour(trips: DataFrame) -> DataFrame:
    """Mean per-trip tip percentage (unclamped) per hour of day."""
    return _tip_pct_by(trips, "hour")


def tip_pct_by_day_of_week(trips: DataFrame) -> DataFrame:
    """Mean per-trip tip percentage (unclamped) per day of week."""
    return _tip_pct_by(trips, "day_of_week")


def tip_pct_by_month(trips: DataFrame) -> DataFrame:
    """Mean per-trip tip percentage (unclamped) per month."""
    return _tip_pct_by(trips, "month")


def tip_ratio_by_pickup(trips: DataFrame) -> DataFrame:
    """``avg(tip) / avg(total) * 100`` per pickup zone, highest first."""
    return (
        trips.groupBy("PULocationID")
        .agg(
            (F.try_divide(F.avg("tip_amount"), F.avg("total_amount")) * 100).alias(
                "tip_percentage"
            )
        )
        .orderBy(F.desc("tip_percentage"), "PULocationID")
    )


def tip_amount_by_hour(trips: DataFrame) -> DataFrame:
    """Average tip amount per hour of day."""
    return (
        trips.groupBy(calendar_keys()["hour"].alias("hour"))
        .agg(F.avg("tip_amount").alias("avg_tip_amount"))
        .transform(sort_bounded, "hour")
    )


def tip_amount_by_payment(trips: DataFrame) -> DataFrame:
    """Average tip amount per payment type."""
    return (
        trips.groupBy("payment_type")
        .agg(F.avg("tip_amount").alias("avg_tip_amount"))
        .transform(sort_bounded, "payment_type")
    )


def tip_clamped_by_od(trips: DataFrame) -> DataFrame:
    """Average clamped tip percentage and average distance per
    pickup x dropoff zone pair, highest tip first."""
    t = with_measures(trips, "tip_percentage_clamped")
    return (
        t.groupBy("PULocationID", "DOLocationID")
        .agg(
            F.avg("tip_percentage_clamped").alias("avg_tip_percentage"),
            F.avg("trip_distance").alias("avg_distance"),
        )
        .orderBy(F.desc("avg_tip_percentage"), "PULocationID", "DOLocationID")
    )


def tip_clamped_by_hour_dow_month(trips: DataFrame) -> DataFrame:
    """Average clamped tip percentage and total tips per calendar cell."""
    t = with_measures(trips, "tip_percentage_clamped", extra=calendar_keys())
    return (
        t.groupBy(*CALENDAR_KEYS)
        .agg(
            F.avg("tip_percentage_clamped").alias("avg_tip_percentage"),
            F.sum("tip_amount").alias("total_tip_amount"),
        )
        .transform(sort_bounded, *CALENDAR_KEYS)
    )


def tip_clamped_by_payment(trips: DataFrame) -> DataFrame:
    """Average clamped tip percentage, average and total tip per payment type."""
    t = with_measures(trips, "tip_percentage_clamped")
    return (
        t.groupBy("payment_type")
        .agg(
            F.avg("tip_percentage_clamped").alias("avg_tip_percentage"),
            F.avg("tip_amount").alias("avg_tip_amount"),
            F.sum("tip_amount").alias("total_tip_amount"),
        )
        .transform(sort_bounded, "payment_type")
    )


def tip_distance_corr(trips: DataFrame) -> DataFrame:
    """Pearson r between per-trip tip percentage and distance (pairs with a
    NULL are left out; NULL if a side is constant), as a one-row DataFrame."""
    t = with_measures(trips, "tip_percentage")
    return t.agg(pearson(F.col("tip_percentage"), F.col("trip_distance")).alias("correlation"))


def tip_pct_by_year_week(trips: DataFrame) -> DataFrame:
    """Mean per-trip tip percentage per ISO year and ISO week."""
    t = with_measures(trips, "tip_percentage")
    ts = pickup()
    return (
        t.groupBy(iso_year_of(ts).alias("iso_year"), iso_week_of(ts).alias("iso_week"))
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.avg("tip_percentage").alias("avg_tip_percentage"),
        )
        .transform(sort_bounded, "iso_year", "iso_week")
    )


def holiday_days(t: DataFrame, holidays: DataFrame | None, *aggregates: Column) -> DataFrame:
    """One row per pickup date: trips, ``aggregates`` and the holiday's name
    (NULL on ordinary days).  A trip without a pickup time falls on no day, so
    it is left out."""
    per_day = (
        t.where(pickup().isNotNull())
        .groupBy(F.to_date(pickup()).alias("pickup_date"))
        .agg(F.count(F.lit(1)).alias("trips"), *aggregates)
    )
    if holidays is None:
        return per_day.withColumn("holiday_name", us_federal_holiday(F.col("pickup_date")))
    one_per_date = holidays.groupBy(F.col("holiday_date").alias("pickup_date")).agg(
        F.min("holiday_name").alias("holiday_name")
    )
    return per_day.join(one_per_date, "pickup_date", "left")


def tip_pct_by_holiday(trips: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Tipping on holidays versus other days.

    One row per holiday name, plus one row with ``holiday_name`` NULL for all
    ordinary days: number of days with trips, trips, mean per-trip tip
    percentage.

    The trips are first reduced to one row per pickup date (a partial/final
    aggregate, so no date -- however hot -- moves more than one row per task),
    and only that per-date table, bounded by the number of days the data
    spans, meets the calendar.  ``holidays`` (``holiday_date`` date,
    ``holiday_name`` string) replaces the built-in US federal calendar; it is
    cut to one name per date and joined to the per-date table, both of which
    are small.
    """
    days = holiday_days(
        with_measures(trips, "tip_percentage"),
        holidays,
        F.sum("tip_percentage").alias("tip_pct_sum"),
        F.count("tip_percentage").alias("tip_pct_n"),
    )
    return (
        days.groupBy("holiday_name")
        .agg(
            F.count(F.lit(1)).alias("days"),
            F.sum("trips").alias("trips"),
            F.try_divide(F.sum("tip_pct_sum"), F.sum("tip_pct_n")).alias(
                "avg_tip_percentage"
            ),
        )
        .transform(sort_bounded, F.col("holiday_name").asc_nulls_first())
    )


def trip_by_holiday(trips: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Average duration (minutes) and distance on holidays versus other days,
    in the shape of ``tip_pct_by_holiday``."""
    days = holiday_days(
        with_measures(trips, "trip_duration_min"),
        holidays,
        F.sum("trip_duration_min").alias("min_sum"),
        F.count("trip_duration_min").alias("min_n"),
        F.sum("trip_distance").alias("mi_sum"),
        F.count("trip_distance").alias("mi_n"),
    )
    return (
        days.groupBy("holiday_name")
        .agg(
            F.count(F.lit(1)).alias("days"),
            F.sum("trips").alias("trips"),
            F.try_divide(F.sum("min_sum"), F.sum("min_n")).alias("avg_duration_min"),
            F.try_divide(F.sum("mi_sum"), F.sum("mi_n")).alias("avg_distance"),
        )
        .transform(sort_bounded, F.col("holiday_name").asc_nulls_first())
    )
