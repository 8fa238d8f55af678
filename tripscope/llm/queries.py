"""The ``opN_<name>`` queries: each operator on its whole table, with the
digest columns its contract names derived from the operator's output."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripscope.llm import (
    bpe,
    decontamination,
    importance,
    mixing,
    periodic,
    pii,
    quality_classifier,
    quality_rules,
    secrets,
    simhash,
    suffix_dedup,
    token_counts,
    toxicity,
)
from tripscope.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = secrets.train_random_model(secrets.labelled_tokens(docs))

    def count(kind: str):
        wanted = secrets.KINDS.index(kind)
        return F.size(F.filter("base", lambda s: s["kind"] == wanted)).cast("long").alias(f"n_{kind}")

    return secrets.find_secrets(docs, model).select(
        "row.doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.fit_quality_rules(docs, table(spark, sf_dir, "labels"))
    return quality_rules.apply_quality_rules(docs.select("doc_id", "text"), rules).select(
        "row.doc_id",
        "stats.n_words",
        "stats.word_chars",
        "stats.n_symbols",
        "stats.n_dup_lines",
        "stats.n_repeat_words",
        "base_failed",
        "kept",
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix_sources(docs).select("row.doc_id", "row.source", "replica", "row.text", "shuffle_key")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_pii(docs, pii.fit_pii(docs))
    base = F.filter("spans", lambda s: s["kind"] < len(pii.KINDS))

    def count(kind: str):
        wanted = pii.KINDS.index(kind)
        return F.size(F.filter("spans", lambda s: s["kind"] == wanted)).cast("long").alias(f"n_{kind}")

    return found.select(
        "row.doc_id",
        *[count(k) for k in pii.KINDS],
        F.sha2(pii.span_text(base), 256).alias("base_sha256"),
        pii.span_text(F.col("spans")).alias("spans"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.fit_quality_classifier(docs, table(spark, sf_dir, "labels"))
    scored = quality_classifier.score_quality(docs.select("doc_id", "text"), model)
    return scored.select(
        F.col("row.doc_id").alias("doc_id"),
        quality_classifier.held_out(F.col("row.doc_id")).alias("held_out"),
        "score",
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.contaminated_pairs(docs, table(spark, sf_dir, "benchmark"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return docs.select(
        "doc_id",
        quality_classifier.held_out(F.col("doc_id")).alias("held_out"),
        toxicity.toxicity_score(F.col("text"), model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_documents(docs).select(
        "row.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = importance.resample(docs, table(spark, sf_dir, "benchmark").select("text"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def looped_words(doc_id: int | None, words: list[str]) -> list[str]:
    """The contract's rewriting: in about a tenth of the documents, chosen by
    a hash of the id, the words from some place on repeat a first stretch."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic.periodic_runs(docs, looped_words)
    # Highest length / period, compared as whole numbers; the runs stand by start, then period.
    best = F.aggregate(
        F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))),
        F.get("runs", F.lit(0)),
        lambda a, r: F.when(r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a),
    )
    lines = F.transform(
        "runs",
        lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")),
    )
    return found.select(
        "row.doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
        best.alias("best"),
    ).select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


QUERIES: dict[str, Query] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_simhash": op2_simhash,
    "op3_secret_scans": op3_secret_scans,
    "op4_quality_rules": op4_quality_rules,
    "op5_mixing": op5_mixing,
    "op6_pii": op6_pii,
    "op7_token_counts": op7_token_counts,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_decontamination": op9_decontamination,
    "op10_toxicity": op10_toxicity,
    "op11_bpe": op11_bpe,
    "op12_importance": op12_importance,
    "op13_periodic_runs": op13_periodic_runs,
}

# DuckDB SQL for the queries that SQL can express whole.
ORACLES: dict[str, str] = {"op5_mixing": mixing.MIX_SQL}
