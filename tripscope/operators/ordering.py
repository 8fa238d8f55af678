"""Ordering of aggregated results.

``orderBy`` plans a range exchange: a sampling job to find the range bounds,
a shuffle, then a sort -- the right plan when the result itself is large.
Results keyed by calendar parts, payment types or passenger counts have a
fixed bound (24 hours, 7 days, 12 months, 2,016 cells) however many trips
there are.  Those are moved into one partition *after* the final aggregate and
sorted there: no sampling job.  Results keyed by zones or zone pairs hold
whatever ids the files hold, which nothing bounds, so they use ``orderBy``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def sort_bounded(df: DataFrame, *cols: str | Column) -> DataFrame:
    """Total order for a result whose size has a fixed bound."""
    return df.repartition(1).sortWithinPartitions(*cols)
