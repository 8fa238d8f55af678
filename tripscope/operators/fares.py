"""Fare analyses and correlations.

Correlations are Pearson's r over the pairs without a NULL (like ``corr``,
unlike ``df.stat.corr``, which counts NULL as 0), NULL when a side is
constant, and stay a one-row DataFrame instead of a number pulled to the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripscope.functions import pearson, with_measures
from tripscope.operators.ordering import sort_bounded


def fare_by_od(trips: DataFrame) -> DataFrame:
    """Average fare per pickup x dropoff zone pair, highest first."""
    return (
        trips.groupBy("PULocationID", "DOLocationID")
        .agg(F.avg("fare_amount").alias("avg_fare"))
        .orderBy(F.desc("avg_fare"), "PULocationID", "DOLocationID")
    )


def fare_by_passengers(trips: DataFrame) -> DataFrame:
    """Average fare per passenger count; NULL passengers form their own group."""
    return (
        trips.groupBy("passenger_count")
        .agg(F.avg("fare_amount").alias("avg_fare"))
        .transform(sort_bounded, "passenger_count")
    )


def fare_distance_corr(trips: DataFrame) -> DataFrame:
    """Pearson r(fare, distance)."""
    return trips.agg(pearson(F.col("fare_amount"), F.col("trip_distance")).alias("correlation"))


def fare_per_mile_distance_corr(trips: DataFrame) -> DataFrame:
    """Pearson r(fare per mile, distance); zero-distance trips have no fare
    per mile and drop out."""
    t = with_measures(trips, "fare_per_mile")
    return t.agg(pearson(F.col("fare_per_mile"), F.col("trip_distance")).alias("correlation"))


def fare_passenger_corr(trips: DataFrame) -> DataFrame:
    """Pearson r(passenger count, fare)."""
    return trips.agg(pearson(F.col("passenger_count"), F.col("fare_amount")).alias("correlation"))
