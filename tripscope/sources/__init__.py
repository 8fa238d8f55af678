"""Sources: trip scans in any format, the lineitem fixture, the source profile."""

from tripscope.sources.lineitem import (
    lineitem_trips_sql,
    trips_from_lineitem,
    trips_from_lineitem_df,
)
from tripscope.sources.profile import source_profile
from tripscope.sources.scan import read_trips, read_trips_csv, read_trips_parquet, split_csv

__all__ = [
    "lineitem_trips_sql",
    "read_trips",
    "read_trips_csv",
    "read_trips_parquet",
    "source_profile",
    "split_csv",
    "trips_from_lineitem",
    "trips_from_lineitem_df",
]
