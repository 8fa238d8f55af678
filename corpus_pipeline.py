"""The corpus pipeline: training-data operators applied one after another.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor
kept and returns a DataFrame; all but the last return the columns of
``docs``.  Between stages the rows are written as Parquet and reread.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripscope.llm import decontamination, mixing, quality_classifier, secrets, simhash
from tripscope.llm.common import discard, stored_at, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects (score < 0.5).

    The model is fitted on labelled rows of the ``documents`` table, so a
    stage input without labelled rows is judged by the same model.
    """
    model = quality_classifier.fit_quality_classifier(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )
    return quality_classifier.score_quality(docs, model).where(F.col("score") >= 0.5).select("row.*")


def dedup_simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash near-duplicate group: 3-word
    shingles, at most 3 differing bits, the smallest doc_id stays."""
    return simhash.keep_one(docs, simhash.SHINGLE_WORDS, simhash.RADIUS)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that cover a benchmark item."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mark; n_chars follows the text.  No document
    is dropped, and one without secrets is unchanged."""
    columns = docs.columns
    model = secrets.train_random_model(secrets.labelled_tokens(docs))
    hit = F.size("spans") > 0
    found = secrets.find_secrets(docs, model).select(
        "row", hit.alias("hit"), F.when(hit, secrets.redact(F.col("text"), F.col("spans"))).alias("new_text")
    )
    changed = {"text": F.when(F.col("hit"), F.col("new_text")).otherwise(F.col("row.text"))}
    if "n_chars" in columns:
        length = F.length("new_text").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("hit"), length).otherwise(F.col("row.n_chars"))
    return found.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns])


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat each document by its Poisson count (equal shares for the
    sources, as many rows in all as came in), in shuffled order.  The copy's
    number is added as ``replica`` (with underscores if that name is taken)."""
    name = "replica"
    while name in docs.columns:
        name += "_"
    return mixing.mix_sources(docs).select("row.*", F.col("replica").alias(name))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", classify_quality),
    ("simhash_near_dedup", dedup_simhash),
    ("benchmark_decontamination", drop_benchmark),
    ("secret_scans", redact_secrets),
    ("mixing_sources", mix_to_weights),
]

# Fitted models and trained scores have no SQL form; tests compare the stages
# with brute-force versions instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the ``documents`` table, with a Parquet cut after each.
    A cut is removed when the next one is written, so one copy of the corpus
    is kept; the last stays, as the result reads it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs, path = stored_at(docs, f"pipeline-{name}")
            if before is not None:
                discard(spark, before)
            before = path
    return docs
