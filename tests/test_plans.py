"""The plans Spark runs, held to the design."""

import os

import pytest
from pyspark.sql import functions as F

import tripscope.operators as ops
from tripscope.plans.catalog import QUERY_FUNCTIONS
from tripscope.plans.inspect import (
    formatted_plan,
    has_node,
    has_python,
    pushed_filters,
    read_schemas,
    scan_count,
)
from tripscope.sinks import write_result
from tripscope.sources import read_trips

from helpers import make_trips

LINEITEM_FOR_DURATION_AND_DISTANCE = {
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate",
}


@pytest.fixture(scope="module")
def trip_files(spark):
    import tempfile

    from tripscope.schema import TRIP_SCHEMA

    path = os.path.join(tempfile.mkdtemp(prefix="tripscope-plan-"), "trips")
    t = make_trips(spark, [{"PULocationID": z % 5} for z in range(50)])
    full = t.select(*[F.col(f.name) if f.name in t.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in TRIP_SCHEMA.fields])
    write_result(full, path)
    return path


def test_mapping_prunes_lineitem_columns(trips_small):
    plan = formatted_plan(ops.trip_by_hour(trips_small))
    (schema,) = read_schemas(plan)
    assert schema <= LINEITEM_FOR_DURATION_AND_DISTANCE


def test_trip_file_scan_reads_only_the_grouping_column(spark, trip_files):
    plan = formatted_plan(ops.pickup_counts(read_trips(spark, trip_files)))
    assert read_schemas(plan) == [{"PULocationID"}]


def test_filters_reach_the_trip_file_scan(spark, trip_files):
    df = ops.fare_by_od(read_trips(spark, trip_files).where(F.col("PULocationID") == 3))
    assert any("EqualTo(PULocationID,3)" in f for f in pushed_filters(formatted_plan(df)))


def test_top_k_is_take_ordered(trips_small):
    plan = formatted_plan(ops.top_pickups(trips_small))
    assert has_node(plan, "TakeOrderedAndProject")


def test_calendar_sets_scan_once(trips_small):
    plan = formatted_plan(ops.trip_calendar_sets(trips_small))
    assert scan_count(plan) == 1 and has_node(plan, "Expand")


def test_partial_aggregation_before_the_shuffle(trips_small):
    plan = formatted_plan(ops.fare_by_od(trips_small))
    assert "partial_avg(fare_amount" in plan


def test_bounded_results_sort_in_one_partition(trips_small):
    plan = formatted_plan(ops.trip_by_hour(trips_small))
    assert "SinglePartition" in plan and "rangepartitioning" not in plan


def test_large_results_sort_by_range(trips_small):
    plan = formatted_plan(ops.speed_by_od_hour_dow_month(trips_small))
    assert "rangepartitioning" in plan


def test_next_hour_labels_do_not_rescan_the_trips(trips_small):
    result = ops.next_hour_labels(trips_small)
    result.collect()
    final = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # The last bucket is found in the hour counts that the labels are made of.
    assert "ReusedExchange" in final and "Join" not in final


def test_holiday_split_joins_no_trip_rows(trips_small):
    plan = formatted_plan(ops.tip_pct_by_holiday(trips_small))
    assert scan_count(plan) == 1 and "Join" not in plan


@pytest.mark.parametrize("key", sorted(QUERY_FUNCTIONS))
def test_no_python_on_the_data_path(trips_small, key):
    assert not has_python(formatted_plan(QUERY_FUNCTIONS[key](trips_small)))


def test_latest_trip_names_the_files_of_the_latest_pickup(spark, trip_files):
    trips = read_trips(spark, trip_files)
    assert len(trips.inputFiles()) > 1
    plan = formatted_plan(ops.latest_trip(trips))
    assert len(read_schemas(plan)) == 1 and "file_path" in plan


def test_latest_trip_of_one_file_compares_whole_rows_of_one_instant(trips_small):
    plan = formatted_plan(ops.latest_trip(trips_small))
    pickup_columns = {"l_orderkey", "l_partkey", "l_linenumber", "l_shipdate"}
    assert pickup_columns in read_schemas(plan) and len(read_schemas(plan)) == 2


def test_source_profile_can_be_answered_from_parquet_footers(spark, trip_files):
    from tripscope.session import FOOTER_AGGREGATES_CONF
    from tripscope.sources import source_profile

    before = {k: spark.conf.get(k, None) for k in FOOTER_AGGREGATES_CONF}
    try:
        for k, v in FOOTER_AGGREGATES_CONF.items():
            spark.conf.set(k, v)
        trips = read_trips(spark, trip_files)
        plan = formatted_plan(source_profile(trips))
        assert "PushedAggregation: [COUNT(*), COUNT(VendorID)" in plan
        rows = {r.column_name: r.non_null_count for r in source_profile(trips).collect()}
        assert rows["PULocationID"] == 50
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
