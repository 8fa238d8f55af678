"""Least squares from sums of products, as column expressions.

``product_sums`` is one aggregate: the count, sums and sums of products of some
features and a label.  These sums add up, so partial aggregates, groups and
prefixes of groups merge by addition, and a model of any union of them needs no
second look at the rows.  ``solve`` turns such sums into coefficients by the
symmetric sweep operator, one projection for each feature: no driver step, and
as many models at once as the table has rows.

A feature whose variance, given the features before it, is nothing but
rounding (a constant, or a combination of the others) is left out: its
coefficient is 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Share of a feature's variance below which it counts as explained by others.
TOLERANCE = 1e-9


def _terms(k: int) -> list[tuple[int, int]]:
    """Index pairs (i <= j) over the constant 0, features 1..k, label k + 1."""
    return [(i, j) for i in range(k + 2) for j in range(i, k + 2)]


def sum_names(k: int, prefix: str = "s") -> list[str]:
    """Column names of the sums for ``k`` features."""
    return [f"{prefix}_{i}_{j}" for i, j in _terms(k)]


def product_sums(features: Sequence[Column], label: Column, prefix: str = "s") -> list[Column]:
    """The aggregates, named by ``sum_names``.  ``s_0_0`` is the number of
    rows that count: those where every feature and the label are there."""
    values = [F.lit(1.0), *[c.cast("double") for c in (*features, label)]]
    there = reduce(and_, [c.isNotNull() for c in (*features, label)])
    return [
        F.sum(F.when(there, values[i] * values[j])).alias(name)
        for (i, j), name in zip(_terms(len(features)), sum_names(len(features), prefix))
    ]


def solve(sums: DataFrame, k: int, prefix: str = "s") -> DataFrame:
    """``sums`` with ``beta_0`` (intercept), ``beta_1`` ... ``beta_k``, ``mse``
    (mean squared residual) and ``variance`` (of the label) of each row's fit;
    all NULL where no row counts."""
    # Expressions as SQL text: a plan of few steps, each analysed once.
    label = k + 1
    pairs = [(i, j) for i, j in _terms(k) if i > 0]
    kept = [f"`{c}`" for c in sums.columns]
    n = f"{prefix}_0_0"

    def mean(i: int) -> str:
        return f"try_divide({prefix}_0_{i}, {n})"

    def cell(i: int, j: int) -> str:
        return f"__c_{min(i, j)}_{max(i, j)}"

    def moment(i: int, j: int) -> str:
        return f"try_divide({prefix}_{i}_{j}, {n}) - {mean(i)} * {mean(j)}"

    # Central moments; those of the features stay for the tolerance.
    variances = [f"__v_{i}" for i in range(1, label + 1)]
    out = sums.selectExpr(
        *kept,
        *[f"{moment(i, j)} AS {cell(i, j)}" for i, j in pairs],
        *[f"{moment(i, i)} AS __v_{i}" for i in range(1, label + 1)],
    )
    for p in range(1, k + 1):
        pivot = cell(p, p)
        used = f"coalesce(__v_{p} > 0 AND {pivot} > {TOLERANCE} * __v_{p}, false)"
        swept = []
        for i, j in pairs:
            if i == p and j == p:
                new = f"try_divide(-1.0D, {pivot})"
            elif p in (i, j):
                new = f"try_divide({cell(i, j)}, {pivot})"
            else:
                new = f"{cell(i, j)} - try_divide({cell(i, p)} * {cell(p, j)}, {pivot})"
            swept.append(f"CASE WHEN {used} THEN {new} ELSE {cell(i, j)} END AS {cell(i, j)}")
        out = out.selectExpr(*kept, *variances, *[f"__in_{q}" for q in range(1, p)], f"{used} AS __in_{p}", *swept)
    betas = {p: f"CASE WHEN {n} > 0 THEN CASE WHEN __in_{p} THEN {cell(p, label)} ELSE 0.0D END END" for p in range(1, k + 1)}
    intercept = mean(label) + "".join(f" - ({beta}) * {mean(p)}" for p, beta in betas.items())
    return out.selectExpr(
        *kept,
        f"{intercept} AS beta_0",
        *[f"{beta} AS beta_{p}" for p, beta in betas.items()],
        f"CASE WHEN {cell(label, label)} < 0 THEN 0.0D ELSE {cell(label, label)} END AS mse",
        f"CASE WHEN __v_{label} < 0 THEN 0.0D ELSE __v_{label} END AS variance",
    )


def not_negative(value: Column) -> Column:
    """A sum of squares that rounding may have pushed below 0 (NULL stays)."""
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def r_squared() -> Column:
    """R^2 of a solved row (not a number for a constant label)."""
    return F.when(F.col("variance") == 0, F.lit(float("nan"))).otherwise(1 - F.try_divide(F.col("mse"), F.col("variance")))


def predict(features: Sequence[Column]) -> Column:
    """The solved row's value at some features."""
    return reduce(lambda a, p: a + F.col(f"beta_{p + 1}") * features[p], range(len(features)), F.col("beta_0"))


def mean_squared_error(k: int, prefix: str) -> Column:
    """The solved row's mean squared error on the rows behind other sums
    (``prefix``), from those sums alone: the mean of (y - b'x)^2."""
    weights = [-F.col("beta_0"), *[-F.col(f"beta_{p}") for p in range(1, k + 1)], F.lit(1.0)]
    total = reduce(
        lambda a, t: a + t,
        [
            weights[i] * weights[j] * F.col(f"{prefix}_{i}_{j}") * (1.0 if i == j else 2.0)
            for i, j in _terms(k)
        ],
    )
    return not_negative(F.try_divide(total, F.col(f"{prefix}_0_0")))
