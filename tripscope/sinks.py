"""Sinks for result tables.

``write_single_csv`` is for small results a person opens (one headed CSV
file).  Results whose size grows with the data go through ``write_result``,
which writes in parallel, one file per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def write_single_csv(
    df: DataFrame,
    path: str,
    sort_by: Sequence[str | Column] = (),
    mode: str = "overwrite",
) -> None:
    """One headed CSV file under ``path``.

    The rows are moved into one partition first and sorted *there*: sorting
    before ``repartition(1)`` would not survive the shuffle.  Meant for
    aggregated results only -- one task writes everything.
    """
    out = df.repartition(1)
    if sort_by:
        out = out.sortWithinPartitions(*sort_by)
    out.write.mode(mode).option("header", "true").csv(path)


def write_result(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
) -> None:
    """Write a result of any size in parallel (optionally partitioned)."""
    writer = df.write.mode(mode).format(format)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if format.lower() == "csv":
        writer = writer.option("header", "true")
    writer.save(path)
