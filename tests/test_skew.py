"""A hot key must not reach one task: checked on Spark's own event log.

A separate Spark application (event log on, written to a scratch folder)
runs analyses over trips where one pickup zone holds more than half of all
rows.  Partial aggregation must keep every task's shuffle output at or
below the number of keys of the query.
"""

import os
import subprocess
import sys
import tempfile
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

from plan_report import shuffle_by_description  # noqa: E402

from helpers import SF_SMALL  # noqa: E402

QUERIES = {  # name -> most rows one task may write to shuffle
    "pickup_counts": 20,
    "trip_by_hour": 24,
    "tip_ratio_by_pickup": 20,
    "speed_by_pickup_hour": 20 * 24,
    "tip_pct_by_holiday": 2600,  # days the fixture spans
}


def test_hot_zone_is_absorbed_by_partial_aggregation():
    scratch = tempfile.mkdtemp(prefix="run-skew-")
    log_dir = os.path.join(scratch, "events")
    os.makedirs(log_dir)
    script = textwrap.dedent(
        f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from pyspark.sql import SparkSession, functions as F
        spark = (SparkSession.builder.master("local[4]")
                 .config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "8")
                 .config("spark.eventLog.enabled", "true")
                 .config("spark.eventLog.dir", {log_dir!r})
                 .config("spark.eventLog.compress", "false")
                 .config("spark.eventLog.rolling.enabled", "false")
                 .getOrCreate())
        import tripscope.operators as ops
        from tripscope.sources import trips_from_lineitem
        t = trips_from_lineitem(spark, {SF_SMALL!r})
        hot = t.withColumn("PULocationID", F.lit(7).cast("bigint"))
        t.unionByName(hot).repartition(8).write.parquet({scratch!r} + "/trips")
        trips = spark.read.parquet({scratch!r} + "/trips")
        n, n_hot = trips.count(), trips.where("PULocationID = 7").count()
        assert n_hot * 2 > n, (n, n_hot)
        for name in {sorted(QUERIES)!r}:
            spark.sparkContext.setJobDescription(name)
            getattr(ops, name)(trips).write.format("noop").mode("overwrite").save()
        spark.stop()
        """
    )
    subprocess.run([sys.executable, "-c", script], check=True, timeout=600, capture_output=True)
    stats = shuffle_by_description(log_dir)
    for name, bound in QUERIES.items():
        assert stats[name]["tasks"] > 1, name
        assert 0 < stats[name]["max_task_shuffle_records"] <= bound, (name, stats[name])
