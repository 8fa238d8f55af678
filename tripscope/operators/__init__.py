"""Analyses: each maps a conformed trips DataFrame to a result DataFrame."""

from tripscope.operators.demand import (
    calendar_totals,
    demand_forecast,
    demand_lr_hourly_total,
    demand_lr_next_hour,
    demand_lr_passengers,
    demand_rolling_error,
    fit_hourly_total_model,
    fit_next_hour_model,
    fit_passenger_model,
    hourly_totals,
    latest_trip,
    next_hour_labels,
)
from tripscope.operators.fares import (
    fare_by_od,
    fare_by_passengers,
    fare_distance_corr,
    fare_passenger_corr,
    fare_per_mile_distance_corr,
)
from tripscope.operators.locations import (
    dropoff_counts,
    pickup_counts,
    top_dropoffs,
    top_pickups,
)
from tripscope.operators.seasons import (
    days_in_ranges,
    season_ranges,
    tip_pct_by_season,
    trip_by_season,
)
from tripscope.operators.speed import (
    speed_by_day_of_week,
    speed_by_hour,
    speed_by_month,
    speed_by_od_hour_dow_month,
    speed_by_od_week,
    speed_by_pickup_hour,
    speed_spread_by_od,
    speed_variance_by_od,
)
from tripscope.operators.tips import (
    tip_amount_by_hour,
    tip_amount_by_payment,
    tip_clamped_by_hour_dow_month,
    tip_clamped_by_od,
    tip_clamped_by_payment,
    tip_distance_corr,
    tip_pct_by_day_of_week,
    tip_pct_by_holiday,
    tip_pct_by_hour,
    tip_pct_by_month,
    tip_pct_by_year_week,
    tip_ratio_by_pickup,
    trip_by_holiday,
)
from tripscope.operators.trips import (
    duration_by_day_of_month,
    elapsed_by_month,
    trip_by_day_of_week,
    trip_by_hour,
    trip_by_hour_dow_month,
    trip_by_month,
    trip_calendar_sets,
)

import inspect as _inspect

__all__ = sorted(
    n for n, v in dict(globals()).items() if _inspect.isfunction(v) and not n.startswith("_")
)
