"""Session defaults for the analyses.

Everything here is a plain Spark setting, and only fills gaps: a key that the
cluster, ``spark-submit`` or an existing session already sets keeps its value.
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Mapping

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # ones, turn a join into a broadcast when a side proves small at runtime.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Calendar keys are read in UTC whatever the machines' zone.
    "spark.sql.session.timeZone": "UTC",
    # No web UI: batch jobs only.
    "spark.ui.enabled": "false",
    # Delete checkpoint files once nothing references them, so the shared
    # checkpoint folder does not grow with every model fit.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


MIB = 1 << 20

# Opt-in: answer count/min/max over Parquet from the file footers.  Needs the
# DataSource V2 Parquet reader (Spark's default is V1 for Parquet); with it,
# ``source_profile`` on trip files reads no data pages at all (its plan shows
# ``PushedAggregation``).  Both settings can be changed on a running session.
FOOTER_AGGREGATES_CONF = {
    "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
    "spark.sql.parquet.aggregatePushdown": "true",
}


# Keys (rows of partial aggregates per map task) that share a shuffle partition.
KEYS_PER_PARTITION = 100_000
MIN_SHUFFLE = 64
# Most keys of a result: calendar cells and zones, or zone pair x calendar cell
# (a few hundred zones), the one result whose key count is large.
SMALL_KEYS = 100_000
PAIR_CELL_KEYS = 265 * 265 * 24 * 7 * 12


def scale_conf(input_bytes: int, total_cores: int, key_bound: int = SMALL_KEYS) -> dict[str, str]:
    """Partition sizing for a trip table of ``input_bytes`` on a cluster of
    ``total_cores`` task slots.

    * Scan splits: every analysis is a cheap per-row projection feeding a
      partial aggregate whose state is one row per key, so a task's memory
      does not grow with its split.  Larger splits (up to 512 MiB) only cut
      the task count: 100 TB in 128 MiB splits is ~800k tasks, in 512 MiB
      ~200k.  Splits stay small enough for at least 4 waves of tasks.
    * Shuffle: what is shuffled is partial aggregates, so the partition count
      follows the result's keys (``key_bound``), not the cores: every map task
      writes one block per partition, and 200,000 tasks times 24,000 partitions
      would be billions of blocks for a 24-row answer.  A partition per
      ``KEYS_PER_PARTITION`` keys, between MIN_SHUFFLE and 3 per core; AQE
      coalesces from there.
    """
    waves = 4
    per_task = max(1, input_bytes // max(1, total_cores * waves))
    split = int(min(512 * MIB, max(64 * MIB, per_task)))
    shuffle = max(MIN_SHUFFLE, min(3 * total_cores, -(-key_bound // KEYS_PER_PARTITION)))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MIB),
    }


def build_session(
    app_name: str = "tripscope",
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """A SparkSession: DEFAULT_CONF for keys nobody set, ``conf`` as given (for
    a large table, pass ``scale_conf(...)`` merged with your own settings).  On
    an existing session only ``conf`` is applied, where it can still change."""
    own = dict(conf or {})
    active = SparkSession.getActiveSession()
    if active is not None:
        # Only what the caller names; the session's other settings are the user's.
        for key, value in own.items():
            if active.conf.isModifiable(key):
                active.conf.set(key, value)
        return active
    SparkContext._ensure_initialized()  # the launcher's settings become visible
    given = SparkConf()
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        if key not in own and not given.contains(key):
            builder = builder.config(key, value)
    for key, value in own.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder: the cluster's ``spark.checkpoint.dir`` if set.

    Only a local session without one (tests, a laptop) gets a fresh local
    folder; on a cluster an unset folder is an error, since a machine-local
    path would not survive the loss of that machine.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's checkpoint folder applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not re.match(r"local(\[|$)", sc.master):  # local-cluster has several machines' folders
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    local = tempfile.mkdtemp(prefix="tripscope-checkpoint-")
    sc.setCheckpointDir(local)
    return local


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a small aggregated table (cuts the lineage)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
