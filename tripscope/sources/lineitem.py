"""Trip rows derived from the driver's ``lineitem`` table.

No test table holds trips, so the fixture maps each ``lineitem`` row to one
trip.  The expressions are plain SQL that runs unchanged in Spark and in the
DuckDB oracle, so both engines see the same per-row values.  The mapping is a
projection only: it fuses into the scan's codegen stage and prunes
``lineitem`` down to the columns it reads.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tripscope.schema import REQUIRED_COLUMNS

# The lineitem -> trip mapping (FIXTURES.md section 2).
# Stage 1 reads lineitem columns only.
LINEITEM_TRIP_STAGE1 = (
    ("VendorID", "l_suppkey % 6 + 1"),
    (
        "tpep_pickup_datetime",
        "l_shipdate + ((l_orderkey * 7919 + l_partkey * 127 + l_linenumber * 3571)"
        " % 86400) * INTERVAL '1' SECOND",
    ),
    (
        "passenger_count",
        "case when l_linenumber = 7 then null else cast(l_linenumber - 1 as double) end",
    ),
    ("trip_distance", "(l_quantity - 1) / 2"),
    ("PULocationID", "l_suppkey % 20 + 1"),
    ("DOLocationID", "l_partkey % 20 + 1"),
    ("payment_type", "cast(case l_returnflag when 'A' then 1 when 'N' then 2 else 3 end as bigint)"),
    ("fare_amount", "l_extendedprice / 1000"),
    ("tip_amount", "l_extendedprice * l_discount * 2 / 1000"),
)
# Stage 2 reads stage-1 columns (and carries l_partkey, l_suppkey, l_tax).
LINEITEM_TRIP_STAGE2 = (
    (
        "tpep_dropoff_datetime",
        "tpep_pickup_datetime + ((l_partkey * 37 + l_suppkey * 11) % 3600) * INTERVAL '1' SECOND",
    ),
    (
        "total_amount",
        "case when l_tax = 0 then 0 when l_tax = 0.08 then tip_amount / 2"
        " else fare_amount + tip_amount + fare_amount * l_tax end",
    ),
)
_CARRIED = ("l_partkey", "l_suppkey", "l_tax")


def trips_from_lineitem_df(lineitem: DataFrame) -> DataFrame:
    """Apply the mapping to a ``lineitem`` DataFrame.

    The second projection emits the required trip columns in TRIP_SCHEMA
    order and types, so the result is already conformed (a test checks
    ``conform`` leaves it unchanged) and no schema round trip is needed.
    """
    stage1 = lineitem.selectExpr(
        *[f"{expr} AS {name}" for name, expr in LINEITEM_TRIP_STAGE1], *_CARRIED
    )
    stage2 = dict(LINEITEM_TRIP_STAGE2)
    return stage1.selectExpr(
        *[f"{stage2[c]} AS {c}" if c in stage2 else c for c in REQUIRED_COLUMNS]
    )


# Parquet schema inference runs a Spark job that reads a footer; the test
# tables are read-only, so each path's schema is inferred once per application.
_SCHEMAS: dict[tuple[str, str], StructType] = {}


def trips_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips for the test tables under ``sf_dir``."""
    path = os.path.join(sf_dir, "lineitem.parquet")
    key = (spark.sparkContext.applicationId, path)
    schema = _SCHEMAS.get(key)
    if schema is None:
        schema = _SCHEMAS[key] = spark.read.parquet(path).schema
    return trips_from_lineitem_df(spark.read.schema(schema).parquet(path))


def lineitem_trips_sql(table: str = "lineitem") -> str:
    """The same mapping as a SQL query over ``table`` (used by the oracle)."""
    s1 = ",\n    ".join(f"{expr} AS {name}" for name, expr in LINEITEM_TRIP_STAGE1)
    s2 = ",\n    ".join(f"{expr} AS {name}" for name, expr in LINEITEM_TRIP_STAGE2)
    carried = ", ".join(_CARRIED)
    return (
        f"SELECT *,\n    {s2}\nFROM (SELECT\n    {s1},\n    {carried}\n  FROM {table}) AS s1"
    )
