"""Derived trip measures as Column expressions (all JVM-side, codegen'd).

Rules kept from the analyses' definitions:

* every ``/`` is ``try_divide``: a zero or NULL divisor gives NULL, never an
  error (Spark runs ANSI) and never infinity;
* averages skip NULL, so a trip with no passengers does not count towards a
  per-passenger average;
* the clamped tip percentage keeps values <= 100 and maps everything else,
  NULL included, to 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripscope.schema import DROPOFF, PICKUP


def duration_seconds() -> Column:
    """Whole seconds from pickup to dropoff."""
    return F.unix_timestamp(F.col(DROPOFF)) - F.unix_timestamp(F.col(PICKUP))


def elapsed_seconds(zone: str) -> Column:
    """Whole seconds that pass from pickup to dropoff on the clocks of ``zone``.

    Stored times are wall-clock times, so over a clock change their difference
    is an hour off.  Both times become instants of the zone first.  A wall time
    that a backward change repeats means its first pass, but a dropoff whose
    first pass lies before the pickup is in the second one; a wall time that a
    forward change skips is read with the clocks not yet moved.
    """

    def instant(wall: Column) -> Column:
        return F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)

    def wall(at: Column) -> Column:
        return F.convert_timezone(F.lit("UTC"), F.lit(zone), at)

    start, end = instant(F.col(PICKUP)), instant(F.col(DROPOFF))
    seconds = F.unix_timestamp(end) - F.unix_timestamp(start)
    out = seconds
    # Clocks move by an hour, in a few places by half of one.
    for step in (30, 60):
        again = wall(end + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(step), F.lit(0))) == F.col(DROPOFF)
        out = F.when((seconds < 0) & again, seconds + 60 * step).otherwise(out)
    return out


def in_zone(trips: DataFrame, zone: str) -> DataFrame:
    """``trips`` with each dropoff set ``elapsed_seconds(zone)`` after the
    pickup, so every analysis of durations and speeds measures the time that
    passed.  Pickups, and the dropoffs of trips over no clock change, stay."""
    length = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), elapsed_seconds(zone).cast("decimal(18,6)"))
    return trips.withColumn(DROPOFF, F.col(PICKUP) + length).select(*trips.columns)


def duration_minutes() -> Column:
    """Trip duration in minutes (whole seconds / 60)."""
    return duration_seconds() / 60.0


def distance_per_passenger() -> Column:
    """Miles per passenger; NULL for zero or unknown passengers."""
    return F.try_divide(F.col("trip_distance"), F.col("passenger_count"))


def tip_percentage() -> Column:
    """Tip as a percentage of the total charged, per trip (unclamped)."""
    return F.try_divide(F.col("tip_amount"), F.col("total_amount")) * 100


def clamp_tip_percentage(pct: Column) -> Column:
    """Values above 100 are treated as outliers and set to 0; so is NULL."""
    return F.when(pct <= 100, pct).otherwise(F.lit(0.0))


def speed_mph() -> Column:
    """Miles per hour from the distance and the duration in seconds."""
    return F.try_divide(F.col("trip_distance"), duration_seconds() / 3600.0)


def fare_per_mile() -> Column:
    """Fare per mile; NULL for zero-distance trips."""
    return F.try_divide(F.col("fare_amount"), F.col("trip_distance"))


_BUILDERS = {
    "trip_duration_s": duration_seconds,
    "trip_duration_min": duration_minutes,
    "distance_per_passenger": distance_per_passenger,
    "tip_percentage": tip_percentage,
    "tip_percentage_clamped": lambda: clamp_tip_percentage(tip_percentage()),
    "trip_speed_mph": speed_mph,
    "fare_per_mile": fare_per_mile,
}
MEASURES = tuple(_BUILDERS)


def with_measures(
    trips: DataFrame, *names: str, extra: dict[str, Column] | None = None
) -> DataFrame:
    """Add the named derived measures (default: all of MEASURES) and any
    ``extra`` columns, in one projection.

    Naming only what a query reads keeps the plan small to build; Catalyst
    would drop unread ones from the executed plan either way.
    """
    cols = {n: _BUILDERS[n]() for n in (names or MEASURES)}
    return trips.withColumns({**cols, **(extra or {})})
