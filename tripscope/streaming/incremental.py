"""Keep an analysis current while monthly trip files keep arriving.

The trip files are a folder that grows by one file a month.  Instead of
recomputing an analysis over every file each time, Structured Streaming
reads only the files it has not seen and folds them into the aggregation
state kept in the checkpoint; each trigger writes the (small) result table anew.

Any analysis that is one aggregation of the trips works unchanged: the
calendar, location, tip, fare and speed results, correlations, the per-trip
regression, the latest trip and the source profile.  Batch only, as they chain
aggregations: the next-hour labels and the models on them, the hourly-total
model and forecast, the variance of similar trips, and the results by holiday
and season.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tripscope.schema import conform
from tripscope.session import ensure_checkpoint_dir
from tripscope.sources.scan import json_in_any_case, json_names


def read_trip_stream(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A streaming DataFrame of conformed trips from a folder of files.

    The stream's schema is taken from the files present at start (Parquet
    footers, the CSV header).  JSON keys are matched in any case in every
    record, of later files too; required keys must occur in the files present
    at start.  CSV is read as strings and cast by header name; a stream
    needs one fixed schema, which Spark applies by position, so every file's
    header is checked against it (``enforceSchema=false``) and a file with
    other columns or another order fails the query instead of being read
    into the wrong columns.
    """
    if format.lower() == "json":
        json_names(spark, [path])
        text = spark.readStream.format("text")
        if max_files_per_trigger:
            text = text.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return conform(json_in_any_case(text.load(path)))
    reader = spark.read.format(format)
    if format.lower() == "csv":
        reader = reader.option("header", "true")
    schema = reader.load(path).schema
    stream = spark.readStream.format(format).schema(schema)
    if format.lower() == "csv":
        stream = stream.option("header", "true").option("enforceSchema", "false")
    if max_files_per_trigger:
        stream = stream.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return conform(stream.load(path))


def read_latest(spark: SparkSession, output_path: str, output_format: str = "parquet") -> DataFrame:
    """The newest complete result that ``start_incremental`` wrote."""
    files = spark.read.format(output_format).load(output_path).inputFiles()
    versions = {int(m[1]) for f in files if (m := re.search(r"/version=(\d+)/", f))}
    if not versions:
        raise FileNotFoundError(f"no result in {output_path}")
    return spark.read.format(output_format).load(os.path.join(output_path, f"version={max(versions)}"))


def start_incremental(
    analysis,
    trips_stream: DataFrame,
    output_path: str,
    name: str,
    checkpoint_location: str | None = None,
    available_now: bool = True,
    output_format: str = "parquet",
) -> StreamingQuery:
    """Run ``analysis`` over the stream; each trigger writes the result anew
    as ``output_path/version=<batch>`` (``read_latest`` reads the newest).

    An earlier version is never touched, so a crash while writing leaves the
    last complete result in place, and the retried batch overwrites only its
    own folder.

    The aggregation state and the progress through the files live under
    ``checkpoint_location`` (default: ``<spark.checkpoint.dir>/streams/<name>``,
    a shared folder on a cluster), so a restarted query resumes where it
    stopped.  ``available_now`` processes the files present and stops.
    """
    spark = trips_stream.sparkSession
    if checkpoint_location is None:
        checkpoint_location = os.path.join(ensure_checkpoint_dir(spark), "streams", name)
    result = analysis(trips_stream)

    def write_batch(batch: DataFrame, _batch_id: int) -> None:
        batch.write.mode("overwrite").format(output_format).save(
            os.path.join(output_path, f"version={_batch_id}")
        )

    writer = (
        result.writeStream.queryName(name)
        .outputMode("complete")
        .option("checkpointLocation", checkpoint_location)
        .foreachBatch(write_batch)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
