"""The trip table: one declared schema and a conforming projection.

Public monthly taxi-trip files are the model.  Only the columns the
analyses read are required; the others are kept when present.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"

TRIP_SCHEMA = T.StructType(
    [
        T.StructField("VendorID", T.LongType()),
        T.StructField(PICKUP, T.TimestampNTZType()),
        T.StructField(DROPOFF, T.TimestampNTZType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.DoubleType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.LongType()),
        T.StructField("DOLocationID", T.LongType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("airport_fee", T.DoubleType()),
    ]
)

# Columns some analysis reads; the rest of TRIP_SCHEMA is optional.
REQUIRED_COLUMNS = (
    "VendorID",
    PICKUP,
    DROPOFF,
    "passenger_count",
    "trip_distance",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "tip_amount",
    "total_amount",
)


class TripSchemaError(ValueError):
    """The input lacks a column the analyses need."""


def conform(df: DataFrame) -> DataFrame:
    """Project ``df`` onto TRIP_SCHEMA: check required columns, cast by name.

    Columns are matched by name, case-insensitively, so CSV headers in any
    order work.  Values that do not parse become NULL (``try_cast``) instead
    of failing a job over one bad row.  Columns outside TRIP_SCHEMA are
    dropped; Catalyst prunes the unread ones from the scan anyway.
    """
    present = {name.lower(): name for name in df.columns}
    missing = [c for c in REQUIRED_COLUMNS if c.lower() not in present]
    if missing:
        raise TripSchemaError(f"trip table lacks required columns: {missing}")
    source_types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for field in TRIP_SCHEMA.fields:
        src = present.get(field.name.lower())
        if src is None:
            continue
        out.append(_cast(F.col(f"`{src}`"), source_types[src], field.dataType).alias(field.name))
    return df.select(*out)


def _cast(col: Column, source: T.DataType, target: T.DataType) -> Column:
    """``col`` as ``target``, NULL where it does not parse.  Whole numbers
    written with a fraction ("132.0", as writers of nullable integers do) keep
    their value; other fractions have no integral value and become NULL."""
    if source == target:
        return col
    if isinstance(target, T.LongType) and not isinstance(source, T.IntegralType):
        number = col.try_cast("double")
        whole = F.when(number == F.floor(number), number.try_cast("bigint"))
        return F.coalesce(col.try_cast("bigint"), whole) if isinstance(source, T.StringType) else whole
    return col.try_cast(target)


def unparsed(df: DataFrame) -> Column:
    """The faults of each row of the raw table ``df``: an array of texts, one
    for each value that is there and that ``conform`` makes NULL."""
    present = {name.lower(): name for name in df.columns}
    types = {f.name: f.dataType for f in df.schema.fields}
    faults = []
    for field in TRIP_SCHEMA.fields:
        src = present.get(field.name.lower())
        if src is None:
            continue
        value = F.col(f"`{src}`")
        lost = value.isNotNull() & _cast(value, types[src], field.dataType).isNull()
        text = F.concat(F.lit(f"{field.name} is not {field.dataType.simpleString()}: "), value.cast("string"))
        faults.append(F.when(lost, text))
    return F.filter(F.array(*faults), lambda f: f.isNotNull())


def cast_losses(df: DataFrame) -> DataFrame:
    """One row per trip column of the raw table ``df``: how many values that
    were there ``conform`` makes NULL (one aggregate pass)."""
    present = {name.lower(): name for name in df.columns}
    types = {f.name: f.dataType for f in df.schema.fields}
    found = [(f, present[f.name.lower()]) for f in TRIP_SCHEMA.fields if f.name.lower() in present]
    counts = df.agg(
        *[
            F.count_if(
                F.col(f"`{src}`").isNotNull() & _cast(F.col(f"`{src}`"), types[src], f.dataType).isNull()
            ).alias(f"c{i}")
            for i, (f, src) in enumerate(found)
        ]
    )
    rows = F.array(
        *[
            F.struct(F.lit(f.name).alias("column_name"), F.col(f"c{i}").alias("lost_count"))
            for i, (f, _) in enumerate(found)
        ]
    )
    return counts.select(F.inline(rows))
