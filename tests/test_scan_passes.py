"""Schema discovery over many files, and records that do not parse."""

import os

import pytest
from pyspark.sql import functions as F

from tripscope.jobs import split_records
from tripscope.schema import TripSchemaError
from tripscope.sinks import write_result, write_single_csv
from tripscope.sources import read_trips, scan, split_csv

from helpers import make_trips, ts


def jobs_of(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_schema_pass_does_not_grow_with_the_files(spark, tmp_dir, fmt):
    t = make_trips(spark, [{"PULocationID": n} for n in range(60)])
    counts = []
    for n in (3, 24):
        path = os.path.join(tmp_dir, f"{fmt}{n}")
        write_result(t.repartition(n), path, fmt)
        assert len(scan.file_list(spark, [path], fmt, {})) == n
        counts.append(jobs_of(spark, f"{fmt}{n}", lambda: read_trips(spark, path, fmt)))
        assert read_trips(spark, path, fmt).count() == 60
    assert counts[0] == counts[1] <= 4


def test_drift_costs_a_read_for_each_schema_not_for_each_file(spark, tmp_dir):
    t = make_trips(spark, [{"passenger_count": 2.0, "PULocationID": n} for n in range(40)])
    long_typed = t.withColumn("passenger_count", F.col("passenger_count").cast("bigint"))
    counts = []
    for n in (2, 9):
        a, b = os.path.join(tmp_dir, f"a{n}"), os.path.join(tmp_dir, f"b{n}")
        write_result(t.repartition(n), a)
        write_result(long_typed.repartition(n), b)
        counts.append(jobs_of(spark, f"drift{n}", lambda: read_trips(spark, [a, b])))
        both = read_trips(spark, [a, b])
        assert both.agg(F.count("*"), F.sum("passenger_count")).first()[:] == (80, 160.0)
    assert counts[0] == counts[1]
    groups = scan.files_by_schema(spark, scan.file_list(spark, [a, b], "parquet", {}), "parquet", {})
    assert sorted(len(v) for v in groups.values()) == [9, 9]


def test_one_file_among_many_that_lacks_a_column_is_named(spark, tmp_dir):
    t = make_trips(spark, [{}] * 8)
    a, b = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "with space")
    write_result(t.repartition(6), a)
    write_result(t.drop("tip_amount").coalesce(1), b)
    with pytest.raises(TripSchemaError, match="tip_amount.*with space"):
        read_trips(spark, [a, b])


def test_files_that_only_spark_reaches_are_asked_one_by_one(spark, tmp_dir, monkeypatch):
    t = make_trips(spark, [{}] * 4)
    a, b = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    write_result(t.repartition(2), a)
    write_result(t.withColumn("airport_fee", F.lit(1.5)).coalesce(1), b)

    def unreachable(fmt):
        def read(parts):
            for part in parts:
                yield part.assign(stored=None)

        return read

    monkeypatch.setattr(scan, "_footer_schemas", unreachable)
    assert read_trips(spark, [a, b]).select("airport_fee").distinct().count() == 2


LINES = [
    "VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,PULocationID,DOLocationID,"
    "payment_type,fare_amount,tip_amount,total_amount",
    "1,2021-03-01 10:00:00,2021-03-01 10:30:00,1.0,5.0,1,2,1,20.0,4.0,25.0",
    "1,2021-03-01 10:00:00,2021-03-01 10:30:00,,5.0,132.0,2,1,20.0,4.0,25.0",
    "1,2021-03-01 10:00:00,2021-03-01 10:30:00,1.0,5.0,1,2,1,n/a,4.0,25.0",
    "1,yesterday,2021-03-01 10:30:00,1.0,5.0,1.5,2,1,20.0,4.0,25.0",
    "1,2021-03-01 10:00:00,2021-03-01 10:30:00",
    "1,2021-03-01 10:00:00,2021-03-01 10:30:00,1.0,5.0,1,2,1,20.0,4.0,25.0,more",
    "",
    ",,,,,,,,,,",
]


def test_every_record_is_a_trip_or_a_reject(spark, tmp_dir):
    for name, lines in (("one.csv", LINES), ("two.csv", LINES[:2])):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write("\n".join(lines) + "\n")
    trips, rejects = split_csv(spark, tmp_dir)
    bad = {r.record: (os.path.basename(r.file), r.reason) for r in rejects.collect()}
    assert trips.count() == 4 and rejects.count() == 4  # 8 records in all; the blank line is none
    assert bad[LINES[3]] == ("one.csv", "fare_amount is not double: n/a")
    assert bad[LINES[4]][1] == "tpep_pickup_datetime is not timestamp_ntz: yesterday; PULocationID is not bigint: 1.5"
    for k in (5, 6):
        assert bad[LINES[k]][1] == "number of fields differs from the header"
    assert sorted(r.PULocationID or 0 for r in trips.collect()) == [0, 1, 1, 132]
    # The counts hold whatever columns a query reads.
    assert trips.select("tip_amount").count() == 4 and rejects.select("file").count() == 4
    assert trips.schema == read_trips(spark, tmp_dir, "csv").schema


def test_clean_and_empty_files_have_no_rejects(spark, tmp_dir):
    t = make_trips(spark, [{"passenger_count": None}, {"tpep_pickup_datetime": ts(2021, 7, 4)}])
    write_single_csv(t, os.path.join(tmp_dir, "clean"))
    trips, rejects = split_csv(spark, os.path.join(tmp_dir, "clean"))
    assert sorted(map(str, trips.collect())) == sorted(map(str, t.collect())) and rejects.count() == 0
    with open(os.path.join(tmp_dir, "none.csv"), "w") as f:
        f.write(LINES[0] + "\n")
    trips, rejects = split_csv(spark, os.path.join(tmp_dir, "none.csv"))
    assert (trips.count(), rejects.count()) == (0, 0)


def test_split_job_writes_both_parts(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "in.csv"), "w") as f:
        f.write("\n".join(LINES) + "\n")
    written = split_records(spark, os.path.join(tmp_dir, "in.csv"), os.path.join(tmp_dir, "out"))
    assert spark.read.parquet(written["trips"]).count() == 3
    assert spark.read.parquet(written["rejects"]).columns == ["file", "record", "reason"]
