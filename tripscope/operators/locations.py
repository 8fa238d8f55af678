"""Popular pickup and dropoff zones.

Counts are partial-aggregated per task before the shuffle, so a zone holding
a third of all trips costs one row per task, not a third of the data in one
reducer.  Top-k uses ``orderBy().limit()``, which Spark plans as
``TakeOrderedAndProject``: each task keeps its own k best, no full sort.  Ties
on the count are broken by the zone id so the top 10 is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


TOP_K = 10


def _counts(trips: DataFrame, zone: str) -> DataFrame:
    return trips.groupBy(zone).agg(F.count(F.lit(1)).alias("count"))


def pickup_counts(trips: DataFrame) -> DataFrame:
    """Trips per pickup zone, busiest first."""
    return _counts(trips, "PULocationID").orderBy(F.desc("count"), "PULocationID")


def dropoff_counts(trips: DataFrame) -> DataFrame:
    """Trips per dropoff zone, busiest first."""
    return _counts(trips, "DOLocationID").orderBy(F.desc("count"), "DOLocationID")


def top_pickups(trips: DataFrame, k: int = TOP_K) -> DataFrame:
    """The k busiest pickup zones."""
    return _counts(trips, "PULocationID").orderBy(F.desc("count"), "PULocationID").limit(k)


def top_dropoffs(trips: DataFrame, k: int = TOP_K) -> DataFrame:
    """The k busiest dropoff zones."""
    return _counts(trips, "DOLocationID").orderBy(F.desc("count"), "DOLocationID").limit(k)
