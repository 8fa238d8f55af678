"""Mixing sources to target weights by Poisson replication.

Source s with n_s documents and target share w_s of ``total`` rows gets the
mean repetition rate w_s * total / n_s.  Each document draws its count from a
Poisson distribution with that mean by inverting the distribution function at
a uniform number hashed from its id and the seed (a binary search in the steps
of its source, which span some deviations around the rate, whatever the rate),
is exploded by the count,
and the copies are dealt and sorted by a second hash: a global shuffle that
comes out the same on every run and every partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripscope.llm.common import stored

SEED = 7
#: Rate tables with more sources than this are joined by a salted shuffle.
BROADCAST_SOURCES = 20_000
#: ... or with more steps in all (8 bytes each).
BROADCAST_STEPS = 4_000_000
SALTS = 64
#: Copies of one document that a task makes in one go.
COPIES_AT_ONCE = 10_000


def hashed_uniform(seed: int, key: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of md5("seed:key")."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def log_poisson(k: Column, rate: Column) -> Column:
    """Logarithm of P(count = k), for k from 0 to the largest exact integers.

    Saddle-point form: the part of size k ln k cancels on paper, not in
    doubles, so the error does not grow with the rate.
    """
    x = F.greatest(k.cast("double"), F.lit(1.0))
    # Stirling's error term of ln k!, by series beyond Spark's exact factorials.
    small = F.ln(F.factorial(F.least(k, F.lit(20)).cast("int")).cast("double")) - (
        (x + 0.5) * F.ln(x) - x + 0.5 * math.log(2 * math.pi)
    )
    y = 1 / (x * x)
    series = (1 / 12.0 - (1 / 360.0 - (1 / 1260.0 - y / 1680.0) * y) * y) / x
    error = F.when(k <= 20, small).otherwise(series)
    off = (x - rate) / rate
    deviance = rate * ((1 + off) * F.log1p(off) - off)
    return F.when(k == 0, -rate).otherwise(-error - deviance - 0.5 * F.ln(2 * math.pi * x))


def step_range(rate: Column) -> tuple[Column, Column]:
    """The counts that doubles can tell from never: rate +- 12 standard
    deviations and 30."""
    width = 12 * F.sqrt(rate) + 30
    return F.greatest(F.floor(rate - width), F.lit(0)).cast("long"), F.ceil(rate + width).cast("long")


def poisson_steps(rates: DataFrame) -> DataFrame:
    """``rates`` (source, rate) with ``low`` and ``steps``: P(count <= k) for
    k = low, low + 1, ... over ``step_range``.

    The steps are rows, summed by a window per source and then gathered: about
    24 * sqrt(rate) + 60 of them, fewer than the source has copies to make once
    the rate passes some thousand.
    """
    low, high = step_range(F.col("rate"))
    rows = rates.where("rate > 0").select(
        "source", "rate", low.alias("low"), F.explode(F.sequence(low, high)).alias("k")
    )
    upto = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.withColumn("c", F.sum(F.exp(log_poisson(F.col("k"), F.col("rate")))).over(upto))
    gathered = F.transform(F.array_sort(F.collect_list(F.struct("k", "c"))), lambda s: s["c"])
    return summed.groupBy("source").agg(F.first("rate").alias("rate"), F.first("low").alias("low"), gathered.alias("steps"))


def steps_below(steps: Column, u: Column) -> Column:
    """How many of the ascending ``steps`` are at most ``u``: a binary search."""
    size = F.size(steps)
    halvings = F.sequence(F.lit(0), F.ceil(F.log2(size.cast("double") + 1)).cast("int"))
    start = F.struct(F.lit(0).alias("a"), size.alias("b"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.shiftright(s["a"] + s["b"], 1)
        return F.when(s["a"] >= s["b"], s).otherwise(
            F.when(
                F.get(steps, middle) <= u, F.struct((middle + 1).alias("a"), s["b"].alias("b"))
            ).otherwise(F.struct(s["a"].alias("a"), middle.alias("b")))
        )

    return F.aggregate(halvings, start, halve, lambda s: s["a"])


def source_rates(docs: DataFrame, weights: Mapping[str | None, float] | None, total: float | None) -> DataFrame:
    """(source, rate), one row per source.

    ``weights``: target share of each source, in any unit (sources it does
    not name get 0); None: equal shares.  ``total``: rows wanted in all; None:
    as many as there are.  A null source is a source of its own.
    """
    sizes = docs.groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        share = F.lit(1.0)
    else:
        share = F.lit(0.0)
        for name, w in weights.items():
            share = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(share)
    sizes = stored(sizes.withColumn("share", share), "source-sizes")
    sums = sizes.agg(F.sum("n").alias("n"), F.sum("share").alias("share")).first()
    wanted = float(total if total is not None else sums["n"] or 0)
    whole = float(sums["share"] or 0.0) or 1.0
    rate = F.col("share") * F.lit(wanted) / (F.lit(whole) * F.col("n"))
    return sizes.select("source", rate.alias("rate"))


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    total: float | None = None,
    seed: int = SEED,
) -> DataFrame:
    """(row, rate, replica, shuffle_key), one row per copy, in shuffled order.

    The order: partitions by hash of the key, sorted by key inside.  Rows with
    equal doc_id (repeated rows) draw the same count.  An empty table gives no
    rows.  Columns of ``docs`` stay inside ``row``, so none can clash.
    """
    rates = stored(poisson_steps(source_rates(docs, weights, total)), "source-rates")
    # A rate of 0 draws no copies, so a source without steps has none.
    size = rates.agg(
        F.count("*").alias("n"), F.sum(F.size("steps")).alias("steps"), F.max(step_range(F.col("rate"))[1]).alias("most")
    ).first()
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("source").alias("s"),
        hashed_uniform(seed, F.col("doc_id")).alias("u"),
    )
    rates = rates.withColumnRenamed("source", "rs")
    match = F.col("s").eqNullSafe(F.col("rs"))
    if size.n <= BROADCAST_SOURCES and (size.steps or 0) <= BROADCAST_STEPS:
        joined = rows.join(F.broadcast(rates), match)
    else:  # a hot source is split over SALTS keys
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("u"), F.lit(SALTS)))
        rates = rates.withColumn("rsalt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.join(rates, match & (F.col("salt") == F.col("rsalt")))
    drawn = joined.select("row", "rate", (F.col("low") + steps_below(F.col("steps"), F.col("u"))).alias("copies"))
    if (size.most or 0) <= COPIES_AT_ONCE:
        numbers = F.sequence(F.lit(1).cast("long"), F.col("copies"))
    else:  # many copies of one document: dealt in blocks to several tasks first
        last = F.floor((F.col("copies") - 1) / F.lit(COPIES_AT_ONCE)).cast("long")
        blocks = drawn.where("copies > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
        drawn = blocks.repartition(F.xxhash64("row.doc_id", "block"))
        first = F.col("block") * COPIES_AT_ONCE
        numbers = F.sequence(first + 1, F.least(first + COPIES_AT_ONCE, F.col("copies")))
    copies = drawn.where("copies > 0").select("row", "rate", F.explode(numbers.cast("array<int>")).alias("replica"))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("row.doc_id").cast("string"), F.lit("null")), F.lit(":"), F.col("replica").cast("string"))
    copies = copies.withColumn("shuffle_key", F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long"))
    return copies.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


MIX_SQL = f"""
WITH sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (
    SELECT source, (SELECT sum(n) FROM sizes)::DOUBLE / ((SELECT count(*) FROM sizes)::DOUBLE * n) AS rate
    FROM sizes
),
steps AS (
    SELECT source, rate, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1)))
           OVER (PARTITION BY source ORDER BY k) AS c
    FROM (SELECT source, rate, unnest(generate_series(0, ceil(rate + 12 * sqrt(rate) + 30)::BIGINT)) AS k FROM rates)
),
uniform AS (
    SELECT doc_id, text, source,
           ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE
           / 4503599627370496.0 AS u
    FROM documents
),
counted AS (
    SELECT d.doc_id, d.text, d.source, count(s.k) AS copies
    FROM uniform d LEFT JOIN steps s ON d.source IS NOT DISTINCT FROM s.source AND s.c <= d.u
    GROUP BY d.doc_id, d.text, d.source
),
copied AS (
    SELECT doc_id, text, source, unnest(generate_series(1, copies)) AS replica FROM counted
)
SELECT doc_id, source, replica::INTEGER AS replica, text,
       ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || replica::VARCHAR), 1, 15))::BIGINT
       AS shuffle_key
FROM copied
"""
