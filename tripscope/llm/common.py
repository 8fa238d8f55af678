"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripscope.session import ensure_checkpoint_dir

#: Tasks that work on a bounded sample.
SAMPLE_TASKS = 32
# Characters that separate words: space and \t \n \v \f \r, nothing else.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A lambda variable is a plain slot, so an array computed from the text is
    not recomputed for every element of an inner higher-order function.
    """
    return F.transform(F.array(value), body)[0]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table through Spark's own reader (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3: the fold of a labelled row."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    rows: int,
    training_fold: bool = True,
    each: bool = False,
    max_chars: int | None = None,
) -> DataFrame:
    """(doc_id, text, label): at most ``rows`` labelled documents (``each``:
    of either label), without those longer than ``max_chars``.

    The rows with the smallest xxhash64 of their id are taken, so the sample
    does not depend on partitioning.  Only ``rows`` ids and labels (a bound
    known in advance) are broadcast to pick the texts out of one scan.
    Rows with a NULL id or label are not sampled; a repeated id counts once,
    with its smallest label and, of its texts, the one with the smallest hash
    (``one_each``).
    """
    wanted = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isNotNull()
    )
    if training_fold:
        wanted = wanted.where(remainder(F.col("doc_id")) != 1)
    wanted = wanted.groupBy("doc_id").agg(F.min("label").alias("label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    if each:
        good = F.col("label") == 1
        wanted = (
            wanted.where(good).orderBy(*order).limit(rows).unionByName(wanted.where(~good).orderBy(*order).limit(rows))
        )
    else:
        wanted = wanted.orderBy(*order).limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id")
    return one_each(found if max_chars is None else found.where(F.length("text") <= max_chars), "label")


def one_each(rows: DataFrame, *others: str) -> DataFrame:
    """One row (doc_id, text, others) per id: the text with the smallest hash.
    A partial aggregate: an id that fills a third of the table leaves one row
    per task."""
    least = F.min(F.struct(F.xxhash64("text").alias("h"), "text", *others))
    return rows.groupBy("doc_id").agg(least.alias("one")).select("doc_id", "one.text", *[f"one.{c}" for c in others])


def hashed_sample(docs: DataFrame, rows: int) -> DataFrame:
    """(doc_id, text) of about ``rows`` documents, never more than twice that,
    one row per id; rows without an id are not sampled.

    The ids under a hash bound are taken, so nothing but the ids is read of
    the other rows, and the sample does not depend on partitioning.
    """
    n = docs.count()
    known = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.col("text").cast("string").alias("text"))
    if n > rows:
        bound = int(-(1 << 63) + (1 << 64) * (rows / n))
        known = known.where(F.xxhash64("doc_id") < F.lit(bound).cast("long"))
    sample = one_each(known).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * rows)
    return sample.repartition(SAMPLE_TASKS, "doc_id")  # the limit left it to one task


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the checkpoint folder and reread.

    Cuts the lineage with columnar, compressed files that every executor
    sees; a lost executor costs a reread, never a recomputation.  The files
    stay until ``clear_stored``.
    """
    return stored_at(df, name)[0]


# Folders that this application wrote and has not removed.
_FOLDERS: dict[str, list[str]] = {}


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``stored``, and the folder it wrote."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _FOLDERS.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``stored_at`` wrote, once nothing reads it."""
    own = _FOLDERS.get(spark.sparkContext.applicationId, [])
    if path in own:
        own.remove(path)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def clear_stored(spark: SparkSession) -> int:
    """Remove every folder that this application's operators stored.  For the
    end of a job: results that were not written elsewhere can be read no more."""
    own = list(_FOLDERS.get(spark.sparkContext.applicationId, []))
    for path in own:
        discard(spark, path)
    return len(own)
