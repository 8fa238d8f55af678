"""Token counts: the exact histogram of encoded lengths and what follows from it.

Documents are encoded whole with a public tokenizer and counted by length, so
what is shuffled is at most one row per task and distinct length.  Suffix sums
over the histogram answer, for every context limit, how many documents exceed
it, the tokens that remain after truncation to it, and the length quantiles.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
import tiktoken
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripscope.llm.common import stored

#: Vocabulary of a byte-level BPE: lines of "base64 rank".
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the splitting pattern that belongs to this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Lengths that share one block of the suffix sums.
BLOCK = 1024


def encoder(ranks: bytes, pattern: str = PATTERN) -> tiktoken.Encoding:
    pairs = (line.split() for line in ranks.splitlines() if line)
    return tiktoken.Encoding(
        "public", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={}
    )


def _lengths(ranks: Broadcast, pattern: str):
    def lengths(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder(ranks.value, pattern).encode_ordinary
        for texts in parts:
            yield pd.Series([len(encode(t)) if t else 0 for t in texts], dtype="int64")

    return lengths


def token_length(spark: SparkSession, text: Column, ranks_path: str = RANKS, pattern: str = PATTERN) -> Column:
    """Tokens of the whole ``text`` (null: 0).  The vocabulary, about a
    megabyte, is read on the driver and broadcast."""
    with open(ranks_path, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())
    return F.pandas_udf(_lengths(ranks, pattern), "long")(text.cast("string"))


def length_histogram(docs: DataFrame, ranks_path: str = RANKS) -> DataFrame:
    """(n_tokens, n_docs, first_doc_id), one row per distinct length.  Null
    and empty texts have length 0; repeated rows count each time."""
    lengths = docs.select("doc_id", token_length(docs.sparkSession, F.col("text"), ranks_path).alias("n_tokens"))
    return lengths.groupBy("n_tokens").agg(
        F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc_id")
    )


def suffix_sums(histogram: DataFrame, block: int = BLOCK) -> DataFrame:
    """The histogram with, for each length as a context limit L:

    tokens (in documents of that length), docs_over and tokens_over (documents
    longer than L), docs_within and tokens_within, tokens_truncated (total if
    every document is cut to L tokens) and share_within (the quantile that L
    is).  Two levels: sums per block of lengths, then inside each block, so no
    task orders more than ``block`` rows but the one over the block totals.
    """
    rows = histogram.withColumn("tokens", F.col("n_tokens") * F.col("n_docs")).withColumn(
        "block", F.floor(F.col("n_tokens") / block)
    )
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    after = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    zero = F.lit(0)
    sums = blocks.select(
        "block",
        F.coalesce(F.sum("d").over(after), zero).alias("d_after"),
        F.coalesce(F.sum("t").over(after), zero).alias("t_after"),
        F.sum("d").over(everything).alias("d_all"),
        F.sum("t").over(everything).alias("t_all"),
    )
    inside = (
        Window.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    )
    out = rows.join(sums, "block").select(
        "n_tokens",
        "n_docs",
        "first_doc_id",
        "tokens",
        (F.col("d_after") + F.coalesce(F.sum("n_docs").over(inside), zero)).alias("docs_over"),
        (F.col("t_after") + F.coalesce(F.sum("tokens").over(inside), zero)).alias("tokens_over"),
        "d_all",
        "t_all",
    )
    return out.select(
        "n_tokens",
        "n_docs",
        "first_doc_id",
        "tokens",
        "docs_over",
        "tokens_over",
        (F.col("d_all") - F.col("docs_over")).alias("docs_within"),
        (F.col("t_all") - F.col("tokens_over")).alias("tokens_within"),
        (F.col("t_all") - F.col("tokens_over") + F.col("n_tokens") * F.col("docs_over")).alias("tokens_truncated"),
        ((F.col("d_all") - F.col("docs_over")) / F.col("d_all")).alias("share_within"),
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, docs_over, tokens_truncated) for any limits: one
    aggregate of the histogram, whatever lengths occur."""
    limit = F.explode(F.array(*[F.lit(int(v)).cast("long") for v in limits])).alias("context_limit")
    return (
        histogram.select("n_tokens", "n_docs", limit)
        .groupBy("context_limit")
        .agg(
            F.sum(F.when(F.col("n_tokens") > F.col("context_limit"), F.col("n_docs")).otherwise(0)).alias("docs_over"),
            F.sum(F.least("n_tokens", "context_limit") * F.col("n_docs")).alias("tokens_truncated"),
        )
    )


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the least length with at least that share of the
    documents within it."""
    wanted = F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")
    return (
        sums.select("n_tokens", "share_within", wanted)
        .where(F.col("share_within") >= F.col("share"))
        .groupBy("share")
        .agg(F.min("n_tokens").alias("n_tokens"))
    )


def token_counts(docs: DataFrame, ranks_path: str = RANKS) -> DataFrame:
    """``suffix_sums`` of the documents' histogram (no documents: no rows).
    The histogram is written out first: encoding runs once."""
    return suffix_sums(stored(length_histogram(docs, ranks_path), "length-histogram"))
