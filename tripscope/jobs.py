"""Batch jobs: a file path in, result tables out.

``duration_reports`` reads trips in any format and writes the average trip
time in minutes per month, per day of month and per hour of day as three
headed CSV files.  The three aggregates come from one scan (grouping sets);
the 67-row result is checkpointed so the three writes do not rescan.

``describe_source`` is the schema check: one row per trip column with its
type and non-NULL count.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripscope.functions import day_of_month_of, duration_minutes, hour_of, month_of, pickup
from tripscope.session import materialize
from tripscope.sinks import write_result, write_single_csv
from tripscope.sources import read_trips, source_profile, split_csv

# Output folder and key column of each report.
DURATION_REPORTS = (
    ("month_analysis", "month"),
    ("day_analysis", "dayofmonth"),
    ("hour_analysis", "hour"),
)
DURATION_COLUMN = "average_trip_time_in_minutes"

# Results whose rows grow with the zones in the files or with the time span:
# never written through one task.
GROWING_RESULTS = frozenset(
    {
        "pickup_counts",
        "dropoff_counts",
        "fare_by_od",
        "tip_clamped_by_od",
        "tip_ratio_by_pickup",
        "speed_by_pickup_hour",
        "speed_spread_by_od",
        "speed_by_od_week",
        "speed_by_od_hour_dow_month",
        "next_hour_labels",
        "tip_pct_by_year_week",
        "speed_variance_by_od",
        "trip_by_season",
        "tip_pct_by_season",
        "demand_rolling_error",
    }
)


def duration_report_table(trips: DataFrame) -> DataFrame:
    """All three reports in one aggregate: ``report`` names the grouping."""
    ts = pickup()
    keyed = trips.select(
        month_of(ts).alias("month"),
        day_of_month_of(ts).alias("dayofmonth"),
        hour_of(ts).alias("hour"),
        duration_minutes().alias("minutes"),
    )
    keys = [F.col(k) for _, k in DURATION_REPORTS]
    gid = F.grouping_id(*keys)
    # One row per cell first (8,928 at most), so the grouping sets expand
    # cells, not trips.
    cells = keyed.groupBy(*keys).agg(F.sum("minutes").alias("s"), F.count("minutes").alias("n"))
    table = cells.groupingSets([[k] for k in keys], *keys).agg(
        gid.alias("__gid"), F.try_divide(F.sum("s"), F.sum("n")).alias(DURATION_COLUMN)
    )
    # grouping_id bits: month = 4, dayofmonth = 2, hour = 1 (1 = rolled up)
    report = (
        F.when(F.col("__gid") == 3, "month_analysis")
        .when(F.col("__gid") == 5, "day_analysis")
        .otherwise("hour_analysis")
    )
    return table.select(report.alias("report"), *[k for _, k in DURATION_REPORTS], DURATION_COLUMN)


def duration_reports(
    spark: SparkSession, input_path: str, output_path: str, format: str = "parquet"
) -> dict[str, str]:
    """Write the three duration reports; returns report name -> folder."""
    table = materialize(duration_report_table(read_trips(spark, input_path, format)))
    written = {}
    for name, key in DURATION_REPORTS:
        folder = os.path.join(output_path, name)
        write_single_csv(
            table.where(F.col("report") == name).select(key, DURATION_COLUMN), folder, [key]
        )
        written[name] = folder
    return written


def describe_source(spark: SparkSession, input_path: str, format: str = "parquet") -> DataFrame:
    """Type and non-NULL count of every trip column of the files."""
    return source_profile(read_trips(spark, input_path, format))


def split_records(spark: SparkSession, input_path: str, output_path: str) -> dict[str, str]:
    """Headed CSV files as ``trips`` and ``rejects`` (file, record, reason),
    two Parquet folders that between them hold every record."""
    written = {}
    for name, part in zip(("trips", "rejects"), split_csv(spark, input_path)):
        written[name] = os.path.join(output_path, name)
        write_result(part, written[name])
    return written


def run_analysis(
    spark: SparkSession,
    name: str,
    input_path: str,
    output_path: str,
    format: str = "parquet",
    output_format: str = "parquet",
) -> None:
    """Run one catalogue analysis on trip files and write its result.  ``csv``
    gives one headed file, sorted in its task by the columns in order, for
    results of fixed size; growing results and other formats are written in
    parallel."""
    from tripscope.plans.catalog import QUERY_FUNCTIONS

    result = QUERY_FUNCTIONS[name](read_trips(spark, input_path, format))
    if output_format == "csv" and name not in GROWING_RESULTS:
        write_single_csv(result, output_path, result.columns)
    else:
        write_result(result, output_path, output_format)


def main(argv: list[str] | None = None) -> None:
    """``spark-submit tripscope/jobs.py <job> --input PATH [--output PATH]``.

    Jobs: ``duration_reports``, ``describe_source`` (printed), ``split_records``
    (CSV in, trips and rejects out), or the name of any analysis in ``queries()``.  With ``--input-bytes`` and
    ``--total-cores`` the partitions are sized by ``session.scale_conf``.
    """
    import argparse

    from tripscope.plans.catalog import QUERY_FUNCTIONS
    from tripscope.session import PAIR_CELL_KEYS, SMALL_KEYS, build_session, scale_conf

    parser = argparse.ArgumentParser(prog="tripscope.jobs")
    parser.add_argument("job", choices=["duration_reports", "describe_source", "split_records", *QUERY_FUNCTIONS])
    parser.add_argument("--input", required=True)
    parser.add_argument("--output")
    parser.add_argument("--format", default="parquet", help="input format")
    parser.add_argument("--output-format", default="parquet")
    parser.add_argument("--input-bytes", type=int, help="input size, to size partitions")
    parser.add_argument("--total-cores", type=int, help="task slots of the cluster")
    args = parser.parse_args(argv)
    if args.job != "describe_source" and not args.output:
        parser.error("--output is required for this job")
    conf = {}
    if args.input_bytes and args.total_cores:
        pairs = args.job in ("speed_by_od_hour_dow_month", "speed_by_od_week")
        conf = scale_conf(args.input_bytes, args.total_cores, PAIR_CELL_KEYS if pairs else SMALL_KEYS)
    spark = build_session(f"tripscope-{args.job}", conf=conf)
    if args.job == "duration_reports":
        duration_reports(spark, args.input, args.output, args.format)
    elif args.job == "split_records":
        split_records(spark, args.input, args.output)
    elif args.job == "describe_source":
        describe_source(spark, args.input, args.format).show(truncate=False)
    else:
        run_analysis(spark, args.job, args.input, args.output, args.format, args.output_format)


if __name__ == "__main__":
    main()
