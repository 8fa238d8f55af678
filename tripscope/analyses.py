"""A whole trip study: many results from few scans.

``study`` returns the results of the sections asked for, keyed by their names
in ``queries()``.  Most results are roll-ups of two small tables: the calendar
cells (hour x day of week x month x day of month, at most 62,496) and the zone
cells (pickup x dropoff x hour).  They hold sums and counts; each is built by
one scan, written once to the checkpoint folder, and shared by every section
that rolls it up.  Results keyed by anything else (payment type, ISO week,
holiday, season, passengers, zone pair by cell, correlations, models) keep a
scan of their own.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import tripscope.operators as ops
from tripscope.functions import calendar_keys, day_of_month_of, pickup, with_measures
from tripscope.operators.locations import TOP_K
from tripscope.operators.ordering import sort_bounded
from tripscope.operators.trips import CALENDAR_KEYS
from tripscope.session import materialize

DERIVED = (
    "trip_duration_s",
    "trip_duration_min",
    "distance_per_passenger",
    "tip_percentage",
    "tip_percentage_clamped",
    "trip_speed_mph",
)
STORED = ("trip_distance", "tip_amount", "total_amount", "fare_amount", "passenger_count")


# ---------------------------------------------------------------- shared cells


def _cells(trips: DataFrame, keys: dict[str, Column], measures: tuple[str, ...]) -> DataFrame:
    derived = [m for m in measures if m in DERIVED]
    table = with_measures(trips, *derived, extra=keys) if derived else trips.withColumns(keys)
    sums = [f(m).alias(f"{n}_{m}") for m in measures for f, n in ((F.sum, "sum"), (F.count, "n"))]
    return materialize(table.groupBy(*keys).agg(F.count(F.lit(1)).alias("trips"), *sums))


def _avg(measure: str) -> Column:
    return F.try_divide(F.sum(f"sum_{measure}"), F.sum(f"n_{measure}"))


def calendar_results(trips: DataFrame) -> dict[str, DataFrame]:
    """Every result keyed by hour, day of week, month or day of month, from
    one scan."""
    keys = {**calendar_keys(), "day_of_month": day_of_month_of(pickup())}
    cells = _cells(trips, keys, (*DERIVED, "trip_distance", "tip_amount", "passenger_count"))

    def by(*names: str, **results: Column) -> DataFrame:
        found = cells.groupBy(*names).agg(*[c.alias(a) for a, c in results.items()])
        return sort_bounded(found, *names)

    out = {}
    for key in CALENDAR_KEYS:
        out[f"trip_by_{key}"] = by(key, avg_duration_min=_avg("trip_duration_min"), avg_distance=_avg("trip_distance"))
        out[f"tip_pct_by_{key}"] = by(key, avg_tip_percentage=_avg("tip_percentage"))
        out[f"speed_by_{key}"] = by(key, avg_speed_mph=_avg("trip_speed_mph"))
    sets = [
        out[f"trip_by_{key}"].select(
            F.lit(key).alias("grouping"),
            *[(F.col(key) if k == key else F.lit(None).cast("int")).alias(k) for k in CALENDAR_KEYS],
            "avg_duration_min",
            "avg_distance",
        )
        for key in CALENDAR_KEYS
    ]
    out["trip_calendar_sets"] = sort_bounded(
        sets[0].unionByName(sets[1]).unionByName(sets[2]), "grouping", *CALENDAR_KEYS
    )
    out["duration_by_day_of_month"] = by("day_of_month", avg_duration_min=_avg("trip_duration_min"))
    out["trip_by_hour_dow_month"] = by(
        *CALENDAR_KEYS,
        avg_duration_s=_avg("trip_duration_s"),
        avg_distance_per_passenger=_avg("distance_per_passenger"),
    )
    out["tip_amount_by_hour"] = by("hour", avg_tip_amount=_avg("tip_amount"))
    out["tip_clamped_by_hour_dow_month"] = by(
        *CALENDAR_KEYS, avg_tip_percentage=_avg("tip_percentage_clamped"), total_tip_amount=F.sum("sum_tip_amount")
    )
    totals = {"total_passengers": F.sum("sum_passenger_count"), "pickups": F.sum("trips")}
    out["hourly_totals"] = by("hour", **totals)
    out["calendar_totals"] = by(*CALENDAR_KEYS, **totals)
    return out


def zone_results(trips: DataFrame) -> dict[str, DataFrame]:
    """Every result keyed by zone, zone pair or pickup zone and hour, from
    one scan."""
    zones = {"PULocationID": F.col("PULocationID"), "DOLocationID": F.col("DOLocationID")}
    cells = _cells(
        trips,
        {**zones, "hour": calendar_keys()["hour"]},
        ("trip_distance", "tip_amount", "total_amount", "fare_amount", "tip_percentage_clamped", "trip_speed_mph"),
    )
    pair = list(zones)
    out = {}
    for name, zone in (("pickup", "PULocationID"), ("dropoff", "DOLocationID")):
        counts = cells.groupBy(zone).agg(F.sum("trips").alias("count")).orderBy(F.desc("count"), zone)
        out[f"{name}_counts"] = counts
        out[f"top_{name}s"] = counts.limit(TOP_K)
    ratio = F.try_divide(_avg("tip_amount"), _avg("total_amount")) * 100
    out["tip_ratio_by_pickup"] = (
        cells.groupBy("PULocationID").agg(ratio.alias("tip_percentage")).orderBy(F.desc("tip_percentage"), "PULocationID")
    )
    out["fare_by_od"] = (
        cells.groupBy(*pair).agg(_avg("fare_amount").alias("avg_fare")).orderBy(F.desc("avg_fare"), *pair)
    )
    out["tip_clamped_by_od"] = (
        cells.groupBy(*pair)
        .agg(_avg("tip_percentage_clamped").alias("avg_tip_percentage"), _avg("trip_distance").alias("avg_distance"))
        .orderBy(F.desc("avg_tip_percentage"), *pair)
    )
    out["speed_by_pickup_hour"] = (
        cells.groupBy("PULocationID", "hour")
        .agg(_avg("trip_speed_mph").alias("avg_speed_mph"))
        .orderBy(F.asc_nulls_first("avg_speed_mph"), "PULocationID", "hour")
    )
    return out


# ---------------------------------------------------------------- sections

# What a section takes from the calendar cells and from the zone cells (name
# prefixes), and the analyses it scans for.
SECTIONS: dict[str, tuple[tuple[str, ...], tuple[str, ...], tuple[str, ...]]] = {
    "trips": (
        ("trip_by_", "trip_calendar_sets", "duration_by_"),
        (),
        ("trip_by_holiday", "trip_by_season", "elapsed_by_month"),
    ),
    "zones": ((), ("top_", "pickup_counts", "dropoff_counts"), ()),
    "tips": (
        ("tip_",),
        ("tip_",),
        (
            "tip_pct_by_year_week",
            "tip_pct_by_holiday",
            "tip_pct_by_season",
            "tip_amount_by_payment",
            "tip_clamped_by_payment",
            "tip_distance_corr",
        ),
    ),
    "fares": (
        (),
        ("fare_by_od",),
        ("fare_by_passengers", "fare_distance_corr", "fare_per_mile_distance_corr", "fare_passenger_corr"),
    ),
    "traffic": (
        ("speed_",),
        ("speed_",),
        ("speed_by_od_hour_dow_month", "speed_spread_by_od", "speed_variance_by_od", "speed_by_od_week"),
    ),
    "demand": (
        ("hourly_totals", "calendar_totals"),
        (),
        (
            "next_hour_labels",
            "demand_lr_passengers",
            "demand_lr_next_hour",
            "demand_lr_hourly_total",
            "demand_rolling_error",
            "demand_forecast",
            "latest_trip",
        ),
    ),
}


def study(trips: DataFrame, sections: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """The results of some SECTIONS (default: all), each under its name in
    ``queries()``.  A cell table that any of them needs is built once."""
    wanted = list(SECTIONS) if sections is None else list(dict.fromkeys(sections))
    unknown = [s for s in wanted if s not in SECTIONS]
    if unknown:
        raise ValueError(f"no such sections: {unknown}; there are {list(SECTIONS)}")
    tables: list[dict[str, DataFrame]] = []
    for part, build in enumerate((calendar_results, zone_results)):
        tables.append(build(trips) if any(SECTIONS[s][part] for s in wanted) else {})
    out: dict[str, DataFrame] = {}
    for section in wanted:
        *prefixes, scanned = SECTIONS[section]
        for table, starts in zip(tables, prefixes):
            out.update({k: v for k, v in table.items() if starts and k.startswith(starts)})
        out.update({name: getattr(ops, name)(trips) for name in scanned})
    return out
