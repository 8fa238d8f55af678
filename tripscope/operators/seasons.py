"""Seasons and events: trips on the days of date ranges that may overlap.

A range has a name, a first and a last day, both included.  A day in several
ranges counts in each; a day in several ranges of one name counts once there;
days in no range make up the row without a name.

The trips are reduced to one row per day (partial aggregates: a day, however
busy, moves one row per task).  Days meet ranges in an interval join that
never compares every day with every range: a range is cut to the span of the
data and dealt to its months, and a day joins the ranges of its month, keeping
those that hold it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripscope.functions import pickup, with_measures
from tripscope.operators.ordering import sort_bounded
from tripscope.session import materialize

# Yearly ranges (name, month and day of the first day, month and
# day of the last; a last day before the first one is in the next year).  They
# overlap on purpose, as a season and the events inside it do.
SEASON_RULES = (
    ("Spring break", 3, 10, 4, 5),
    ("Summer season", 6, 15, 9, 7),
    ("Independence week", 7, 1, 7, 7),
    ("Thanksgiving season", 11, 15, 12, 1),
    ("Holiday season", 11, 25, 1, 1),
    ("Year end", 12, 24, 1, 2),
)


def season_ranges(days: DataFrame) -> DataFrame:
    """(season_name, first_day, last_day): SEASON_RULES in every year that the
    dates of ``days`` (pickup_date) touch."""
    rules = F.array(
        *[
            F.struct(*[F.lit(v).alias(c) for v, c in zip(rule, ("season_name", "m1", "d1", "m2", "d2"))])
            for rule in SEASON_RULES
        ]
    )
    years = days.agg(F.min("pickup_date").alias("a"), F.max("pickup_date").alias("b")).where("a IS NOT NULL")
    years = years.select(F.explode(F.sequence(F.year("a") - 1, F.year("b"))).alias("year"))
    later = F.when(F.struct("m2", "d2") < F.struct("m1", "d1"), 1).otherwise(0)
    return years.select("year", F.inline(rules)).select(
        "season_name",
        F.make_date("year", "m1", "d1").alias("first_day"),
        F.make_date(F.col("year") + later, "m2", "d2").alias("last_day"),
    )


def days_in_ranges(days: DataFrame, ranges: DataFrame) -> DataFrame:
    """``days`` (one row per pickup_date) with ``season_name``: a row for each
    name whose ranges hold the day, or one row without a name.

    Ranges without a name, without either day, or that end before they begin
    hold no day.
    """
    span = days.agg(F.min("pickup_date").alias("a"), F.max("pickup_date").alias("b"))
    kept = ranges.select("season_name", "first_day", "last_day").where(
        "season_name IS NOT NULL AND first_day <= last_day"
    )
    # One row joined to a few ranges: the span of the data.
    cut = kept.crossJoin(F.broadcast(span)).where("first_day <= b AND last_day >= a")
    cut = cut.select("season_name", F.greatest("first_day", "a").alias("first_day"), F.least("last_day", "b").alias("last_day"))
    month = F.expr("INTERVAL 1 MONTH")
    dealt = cut.select(
        "*", F.explode(F.sequence(F.trunc("first_day", "month"), F.trunc("last_day", "month"), month)).alias("range_month")
    )
    hit = (F.trunc("pickup_date", "month") == F.col("range_month")) & F.col("pickup_date").between(
        F.col("first_day"), F.col("last_day")
    )
    found = days.join(dealt, hit, "left").select(*days.columns, "season_name")
    return found.dropDuplicates(["pickup_date", "season_name"])


def _by_season(trips: DataFrame, ranges: DataFrame | None, measures: dict[str, str]) -> DataFrame:
    """Days, trips and the mean of each measure (result name -> column)."""
    sums = [f(c).alias(f"{n}_{c}") for c in measures.values() for f, n in ((F.sum, "s"), (F.count, "n"))]
    days = (
        trips.where(pickup().isNotNull())
        .groupBy(F.to_date(pickup()).alias("pickup_date"))
        .agg(F.count(F.lit(1)).alias("trips"), *sums)
    )
    days = materialize(days)  # read for the span, the years and the join; one row a day

    def mean(c: str) -> Column:
        return F.try_divide(F.sum(f"s_{c}"), F.sum(f"n_{c}"))

    return (
        days_in_ranges(days, season_ranges(days) if ranges is None else ranges)
        .groupBy("season_name")
        .agg(
            F.count(F.lit(1)).alias("days"),
            F.sum("trips").alias("trips"),
            *[mean(c).alias(name) for name, c in measures.items()],
        )
        .orderBy(F.col("season_name").asc_nulls_first())
    )


def trip_by_season(trips: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """Average duration (minutes) and distance in each season or event, and
    on ordinary days (``season_name`` NULL).

    ``ranges``: a table (season_name string, first_day date, last_day date) of
    any size; by default SEASON_RULES of the years in the data.
    """
    return _by_season(
        with_measures(trips, "trip_duration_min"),
        ranges,
        {"avg_duration_min": "trip_duration_min", "avg_distance": "trip_distance"},
    )


def tip_pct_by_season(trips: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """Mean per-trip tip percentage (unclamped) in the shape of
    ``trip_by_season``."""
    return _by_season(with_measures(trips, "tip_percentage"), ranges, {"avg_tip_percentage": "tip_percentage"})
