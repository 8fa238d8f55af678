import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[4]")
        .appName("tripscope-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Tests only: a local checkpoint folder when the session names none.
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get(
        "spark.checkpoint.dir", None
    ):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tripscope-test-ckpt-"))
    yield spark


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tripscope-test-")


@pytest.fixture(scope="session")
def trips_small(spark):
    from helpers import SF_SMALL
    from tripscope.sources import trips_from_lineitem

    return trips_from_lineitem(spark, SF_SMALL)
