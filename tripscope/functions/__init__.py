"""Column expressions: derived trip measures and calendar keys."""

from tripscope.functions.calendar import (
    US_FEDERAL_HOLIDAY_RULES,
    calendar_keys,
    day_of_month_of,
    day_of_week_of,
    hour_of,
    iso_week_of,
    iso_year_of,
    month_of,
    pickup,
    us_federal_holiday,
)
from tripscope.functions.columns import (
    clamp_tip_percentage,
    distance_per_passenger,
    duration_minutes,
    duration_seconds,
    elapsed_seconds,
    fare_per_mile,
    in_zone,
    speed_mph,
    tip_percentage,
    with_measures,
)
from tripscope.functions.stats import pearson

__all__ = [
    "US_FEDERAL_HOLIDAY_RULES",
    "calendar_keys",
    "clamp_tip_percentage",
    "day_of_month_of",
    "day_of_week_of",
    "distance_per_passenger",
    "duration_minutes",
    "duration_seconds",
    "elapsed_seconds",
    "fare_per_mile",
    "hour_of",
    "in_zone",
    "iso_week_of",
    "iso_year_of",
    "month_of",
    "pearson",
    "pickup",
    "speed_mph",
    "tip_percentage",
    "us_federal_holiday",
    "with_measures",
]
