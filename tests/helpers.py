"""Table folders and hand-made trips for the tests."""

import datetime as dt

from tripscope.schema import REQUIRED_COLUMNS, TRIP_SCHEMA, conform

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"

_FIELDS = {f.name: f for f in TRIP_SCHEMA.fields}
_DEFAULTS = {
    "VendorID": 1,
    "tpep_pickup_datetime": dt.datetime(2021, 3, 1, 10, 0, 0),
    "tpep_dropoff_datetime": dt.datetime(2021, 3, 1, 10, 30, 0),
    "passenger_count": 1.0,
    "trip_distance": 5.0,
    "PULocationID": 1,
    "DOLocationID": 2,
    "payment_type": 1,
    "fare_amount": 20.0,
    "tip_amount": 4.0,
    "total_amount": 25.0,
}


def make_trips(spark, rows):
    """``rows``: dicts overriding the defaults; columns are REQUIRED_COLUMNS."""
    from pyspark.sql import types as T

    schema = T.StructType([_FIELDS[c] for c in REQUIRED_COLUMNS])
    data = [tuple({**_DEFAULTS, **r}[c] for c in REQUIRED_COLUMNS) for r in rows]
    return conform(spark.createDataFrame(data, schema))


def ts(*args):
    return dt.datetime(*args)
