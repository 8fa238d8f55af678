"""Awkward trips through every key, compared with DuckDB on the same rows, and
the source rules for drifting files."""

import math
import os

import pytest
from pyspark.sql import functions as F

from oracle_check import compare
from helpers import make_trips, ts
from tripscope.plans import catalog, oracle
from tripscope.schema import TripSchemaError, cast_losses, conform
from tripscope.sources import lineitem_trips_sql, read_trips

KEYS = sorted(catalog.QUERY_FUNCTIONS)


def _rows():
    rows = []
    for k in range(240):
        hour, day, month = k % 24, 1 + (k * 5) % 28, 1 + (k * 7) % 12
        rows.append(
            {
                "tpep_pickup_datetime": ts(2021, month, day, hour, k % 60),
                "tpep_dropoff_datetime": ts(2021, month, day, hour, 59, 30) if k % 60 < 59 else ts(2021, month, day, hour, 58),
                "passenger_count": float(k % 5) if k % 11 else None,
                "trip_distance": (k % 17) / 4.0,
                "fare_amount": 3.0 + k % 9,
                "tip_amount": float(k % 4),
                "total_amount": float(k % 13),
                "PULocationID": k % 3 if k % 19 else None,
                "DOLocationID": k % 4,
                "payment_type": k % 3,
            }
        )
    rows[5]["tpep_pickup_datetime"] = None
    rows[77]["tpep_pickup_datetime"] = None
    rows[9]["tpep_dropoff_datetime"] = None
    rows[12]["tpep_dropoff_datetime"] = ts(2020, 12, 31, 1)  # negative duration
    rows[30]["tpep_dropoff_datetime"] = rows[30]["tpep_pickup_datetime"]  # zero duration
    return rows


@pytest.fixture(scope="module")
def awkward(spark):
    import duckdb

    trips = make_trips(spark, _rows()).repartition(3).cache()
    con = duckdb.connect()
    frame = trips.toPandas()  # noqa: F841  (read by name below)
    casts = ", ".join(
        f"{f.name}::{ {'bigint': 'BIGINT', 'double': 'DOUBLE', 'timestamp_ntz': 'TIMESTAMP'}[f.dataType.simpleString()] } AS {f.name}"
        for f in trips.schema.fields
    )
    con.execute(f"CREATE TABLE awkward AS SELECT {casts} FROM frame")
    return trips, con


@pytest.mark.parametrize("key", KEYS)
def test_every_key_on_awkward_trips(spark, awkward, key):
    trips, con = awkward
    sql = oracle.oracle_sql()[key].replace(lineitem_trips_sql(), "SELECT * FROM awkward")
    run = lambda s, d: catalog.round_doubles(catalog.QUERY_FUNCTIONS[key](trips))
    ok, msg = compare(spark, con, key, run, sql, "")
    assert ok, msg


def test_constant_column_has_no_correlation(spark):
    for parts in (1, 3, 7):
        t = make_trips(spark, [{"fare_amount": 0.1, "trip_distance": float(k)} for k in range(500)]).repartition(parts)
        assert catalog.QUERY_FUNCTIONS["fare_distance_corr"](t).first().correlation is None


def test_exact_fit_has_rmse_zero(spark):
    t = make_trips(
        spark,
        [{"tpep_pickup_datetime": ts(2021, 3, 1, k % 24), "passenger_count": 0.1 + 0.3 * (k % 24)} for k in range(240)],
    )
    r = catalog.QUERY_FUNCTIONS["demand_lr_passengers"](t).first()
    assert r.r2 <= 1.0 and not math.isnan(r.rmse) and r.rmse < 1e-6


def test_ids_with_a_fraction_keep_their_value(spark, tmp_dir):
    path = os.path.join(tmp_dir, "trips.csv")
    raw = make_trips(spark, [{"PULocationID": 132}, {"PULocationID": 7}]).select(
        *[F.col(c).cast("string").alias(c) if c != "PULocationID" else F.col(c).cast("double").cast("string").alias(c)
          for c in make_trips(spark, []).columns]
    )
    raw.write.option("header", True).csv(path)
    assert sorted(r.PULocationID for r in read_trips(spark, path, "csv").collect()) == [7, 132]
    odd = raw.withColumn("PULocationID", F.lit("1.5")).withColumn("fare_amount", F.lit("n/a"))
    assert {r.PULocationID for r in conform(odd).collect()} == {None}
    lost = {r.column_name: r.lost_count for r in cast_losses(odd).collect()}
    assert lost["PULocationID"] == 2 and lost["fare_amount"] == 2 and lost["tip_amount"] == 0


def test_json_names_in_any_case_and_missing_keys(spark, tmp_dir):
    t = make_trips(spark, [{"PULocationID": 9}])
    low = os.path.join(tmp_dir, "low.json")
    t.select(*[F.col(c).alias(c.lower()) for c in t.columns]).write.json(low)
    r = read_trips(spark, low, "json").first()
    assert (r.PULocationID, r.fare_amount, r.tpep_pickup_datetime) == (9, 20.0, ts(2021, 3, 1, 10))
    short = os.path.join(tmp_dir, "short.json")
    t.drop("tip_amount").write.json(short)
    with pytest.raises(TripSchemaError, match="tip_amount"):
        read_trips(spark, short, "json")


def test_drifting_parquet_files(spark, tmp_dir):
    t = make_trips(spark, [{"passenger_count": 2.0}])
    t.coalesce(1).write.parquet(os.path.join(tmp_dir, "m1"))
    t.withColumn("passenger_count", F.col("passenger_count").cast("bigint")).withColumn(
        "airport_fee", F.lit(1.25)
    ).coalesce(1).write.parquet(os.path.join(tmp_dir, "m2"))
    both = read_trips(spark, [os.path.join(tmp_dir, "m1"), os.path.join(tmp_dir, "m2")])
    assert sorted((r.passenger_count, r.airport_fee) for r in both.fillna(0.0, ["airport_fee"]).collect()) == [
        (2.0, 0.0),
        (2.0, 1.25),
    ]
    t.drop("tip_amount").coalesce(1).write.parquet(os.path.join(tmp_dir, "m3"))
    with pytest.raises(TripSchemaError, match="tip_amount"):
        read_trips(spark, [os.path.join(tmp_dir, "m1"), os.path.join(tmp_dir, "m3")])


def test_existing_session_keeps_its_settings(spark):
    from tripscope.session import build_session

    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert build_session(conf={"spark.sql.shuffle.partitions": "8"}).conf.get("spark.sql.session.timeZone") == "America/New_York"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_cells_are_aggregated_below_the_expand(spark):
    from tripscope.jobs import duration_report_table

    t = make_trips(spark, _rows())
    for df in (catalog.QUERY_FUNCTIONS["trip_calendar_sets"](t), duration_report_table(t)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        above, below = plan.split("Expand", 1)
        assert "Aggregate" in below


def test_growing_results_are_not_written_by_one_task():
    from tripscope.jobs import GROWING_RESULTS

    assert GROWING_RESULTS <= set(catalog.QUERY_FUNCTIONS)
    assert "speed_by_od_hour_dow_month" in GROWING_RESULTS
