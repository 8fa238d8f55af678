"""Calendar keys of the pickup time, and a rule-based holiday calendar.

Day of week uses Spark's coding everywhere, training and prediction alike:
1 = Sunday ... 7 = Saturday.  ISO year and week are taken together so the
turn of the year lands in the right week.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripscope.schema import PICKUP


def pickup() -> Column:
    return F.col(PICKUP)


def hour_of(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week_of(ts: Column) -> Column:
    return F.dayofweek(ts)


def month_of(ts: Column) -> Column:
    return F.month(ts)


def day_of_month_of(ts: Column) -> Column:
    return F.dayofmonth(ts)


def iso_year_of(ts: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), ts)


def iso_week_of(ts: Column) -> Column:
    return F.weekofyear(ts)


def calendar_keys(ts: Column | None = None) -> dict[str, Column]:
    """hour, day_of_week, month of a timestamp (default: the pickup)."""
    ts = pickup() if ts is None else ts
    return {
        "hour": hour_of(ts),
        "day_of_week": day_of_week_of(ts),
        "month": month_of(ts),
    }


# United States federal holidays, by rule.
# (name, month, fixed day of month or None, weekday 1=Sunday..7=Saturday or
#  None, first and last day of month the weekday may fall on, first year)
US_FEDERAL_HOLIDAY_RULES = (
    ("New Year's Day", 1, 1, None, None, None, None),
    ("Martin Luther King Jr. Day", 1, None, 2, 15, 21, 1986),
    ("Washington's Birthday", 2, None, 2, 15, 21, None),
    ("Memorial Day", 5, None, 2, 25, 31, None),
    ("Juneteenth", 6, 19, None, None, None, 2021),
    ("Independence Day", 7, 4, None, None, None, None),
    ("Labor Day", 9, None, 2, 1, 7, None),
    ("Columbus Day", 10, None, 2, 8, 14, None),
    ("Veterans Day", 11, 11, None, None, None, None),
    ("Thanksgiving Day", 11, None, 5, 22, 28, None),
    ("Christmas Day", 12, 25, None, None, None, None),
)


def us_federal_holiday(date: Column) -> Column:
    """Name of the federal holiday on ``date`` (actual day, not the observed
    weekday), or NULL.  A pure expression: no join, no shuffle."""
    m, d, w, y = F.month(date), F.dayofmonth(date), F.dayofweek(date), F.year(date)
    branches = []
    for name, month, day, weekday, first, last, since in US_FEDERAL_HOLIDAY_RULES:
        cond = m == month
        if day is not None:
            cond = cond & (d == day)
        else:
            cond = cond & (w == weekday) & d.between(first, last)
        if since is not None:
            cond = cond & (y >= since)
        branches.append((cond, name))
    first_cond, first_name = branches[0]
    expr = F.when(first_cond, F.lit(first_name))
    return reduce(lambda acc, b: acc.when(b[0], F.lit(b[1])), branches[1:], expr)
