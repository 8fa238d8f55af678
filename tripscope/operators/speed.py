"""Traffic speed: miles per hour from distance and duration in seconds.

A zero-duration trip has no speed (NULL) and drops out of the averages.
``speed_by_od_hour_dow_month`` is the one result whose size grows with the
data (zones squared x 24 x 7 x 12 cells); its final ordering is a range
shuffle of the *aggregated* rows, never of the trips.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripscope.functions import calendar_keys, iso_week_of, pickup, with_measures
from tripscope.operators.ordering import sort_bounded
from tripscope.operators.trips import CALENDAR_KEYS


def _speed_by(trips: DataFrame, key: str) -> DataFrame:
    t = with_measures(trips, "trip_speed_mph")
    return (
        t.groupBy(calendar_keys()[key].alias(key))
        .agg(F.avg("trip_speed_mph").alias("avg_speed_mph"))
        .transform(sort_bounded, key)
    )


def speed_by_hour(trips: DataFrame) -> DataFrame:
    """Mean speed (mph) per hour of day."""
    return _speed_by(trips, "hour")


def speed_by_day_of_week(trips: DataFrame) -> DataFrame:
    """Mean speed (mph) per day of week (1 = Sunday)."""
    return _speed_by(trips, "day_of_week")


def speed_by_month(trips: DataFrame) -> DataFrame:
    """Mean speed (mph) per month of year."""
    return _speed_by(trips, "month")


def speed_by_pickup_hour(trips: DataFrame) -> DataFrame:
    """Mean speed per pickup zone x hour of day, slowest first."""
    t = with_measures(trips, "trip_speed_mph")
    return (
        t.groupBy("PULocationID", calendar_keys()["hour"].alias("hour"))
        .agg(F.avg("trip_speed_mph").alias("avg_speed_mph"))
        .orderBy(F.asc_nulls_first("avg_speed_mph"), "PULocationID", "hour")
    )


def speed_by_od_hour_dow_month(trips: DataFrame) -> DataFrame:
    """Mean speed per pickup x dropoff x hour x day of week x month."""
    keys = ("PULocationID", "DOLocationID", *CALENDAR_KEYS)
    t = with_measures(trips, "trip_speed_mph", extra=calendar_keys())
    return (
        t.groupBy(*keys)
        .agg(F.avg("trip_speed_mph").alias("avg_speed_mph"))
        .orderBy(*keys)
    )


def speed_spread_by_od(trips: DataFrame) -> DataFrame:
    """Do similar trips have similar speeds?  Per pickup x dropoff pair:
    trips with a speed, mean, sample standard deviation and coefficient of
    variation (stddev / mean) of the speed."""
    t = with_measures(trips, "trip_speed_mph")
    return (
        t.groupBy("PULocationID", "DOLocationID")
        .agg(
            F.count("trip_speed_mph").alias("trips"),
            F.avg("trip_speed_mph").alias("avg_speed_mph"),
            F.stddev_samp("trip_speed_mph").alias("stddev_speed_mph"),
        )
        .withColumn("speed_cv", F.try_divide(F.col("stddev_speed_mph"), F.col("avg_speed_mph")))
        .orderBy("PULocationID", "DOLocationID")
    )


# Lower ends, in miles, of the distance bands of similar trips.
DISTANCE_BANDS = (0.0, 1.0, 2.0, 5.0, 10.0, 20.0)

_MOMENTS = ("n", "mean", "m2")


def _merged(states: Column) -> Column:
    """One (n, mean, m2) from an array of them, in its order: counts, means
    and sums of squared deviations of disjoint groups merge exactly, without
    the cancellation of sums of squares."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def merge(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        gap = b["mean"] - a["mean"]
        return F.struct(
            n.alias("n"),
            (a["mean"] + gap * b["n"] / n).alias("mean"),
            (a["m2"] + b["m2"] + gap * gap * a["n"] * b["n"] / n).alias("m2"),
        )

    return F.aggregate(F.transform(states, lambda s: F.struct(*[s[c].alias(c) for c in _MOMENTS])), zero, merge)


def _roll_up(cells: DataFrame, keys: list[str], by: str, inner: list[str]) -> DataFrame:
    """Merge the cells of each ``keys`` group, in the order of ``by``; the sums
    of squares in ``inner`` add up.  A group has one cell for each value of
    ``by``, a fixed few."""
    state = F.struct(by, *[F.col(c) for c in _MOMENTS])
    merged = _merged(F.array_sort(F.collect_list(state)))
    return cells.groupBy(*keys).agg(merged.alias("all"), *[F.sum(c).alias(c) for c in inner]).select(*keys, "all.*", *inner)


def speed_variance_by_od(trips: DataFrame) -> DataFrame:
    """Do similar trips have the same speed?  Where the variance of the speed
    between two zones comes from.

    Per pickup x dropoff pair: ``trips`` with a speed, ``avg_speed_mph``,
    ``var_total`` (population variance) and its parts: ``var_between_hours``
    (between the hours of the day: traffic), ``var_between_bands`` (between
    distance bands within an hour: other routes) and ``var_within`` (trips of
    one pair, hour and band: as similar as the data tell).  The parts add up to
    the total; ``similar_share`` is ``var_within / var_total``.

    One aggregate of the trips, at the finest groups; count, mean and squared
    deviations are then merged twice, within at most one row per band and hour.
    """
    pair = ["PULocationID", "DOLocationID"]
    mile = F.col("trip_distance")
    band = sum((F.when(mile >= edge, 1).otherwise(0) for edge in DISTANCE_BANDS), F.lit(0))
    speed = F.col("trip_speed_mph")
    t = with_measures(trips, "trip_speed_mph", extra={"hour": calendar_keys()["hour"], "band": band})
    cells = (
        t.where(speed.isNotNull())
        .groupBy(*pair, "hour", "band")
        .agg(
            F.count(speed).alias("n"),
            F.avg(speed).alias("mean"),
            (F.var_pop(speed) * F.count(speed)).alias("m2"),
        )
    )
    cells = cells.withColumn("within", F.col("m2"))
    hours = _roll_up(cells, [*pair, "hour"], "band", ["within"]).withColumn("in_hours", F.col("m2"))
    pairs = _roll_up(hours, pair, "hour", ["within", "in_hours"])

    def part(c: Column) -> Column:
        return F.greatest(c, F.lit(0.0)) / F.col("n")  # a difference may round below 0

    return pairs.select(
        *pair,
        F.col("n").alias("trips"),
        F.col("mean").alias("avg_speed_mph"),
        part(F.col("m2")).alias("var_total"),
        part(F.col("m2") - F.col("in_hours")).alias("var_between_hours"),
        part(F.col("in_hours") - F.col("within")).alias("var_between_bands"),
        part(F.col("within")).alias("var_within"),
        F.when(F.col("n") > 1, F.try_divide(F.col("within"), F.col("m2"))).alias("similar_share"),
    ).orderBy(*pair)


def speed_by_od_week(trips: DataFrame) -> DataFrame:
    """Mean speed per pickup x dropoff pair and ISO week of year."""
    t = with_measures(trips, "trip_speed_mph")
    return (
        t.groupBy("PULocationID", "DOLocationID", iso_week_of(pickup()).alias("week_of_year"))
        .agg(F.avg("trip_speed_mph").alias("avg_speed_mph"))
        .orderBy("PULocationID", "DOLocationID", "week_of_year")
    )
