"""Aggregate statistics with the NULL and zero rules of the analyses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pearson(x: Column, y: Column) -> Column:
    """Pearson r over the rows where both values are non-NULL (like
    ``corr``), but NULL instead of an error when either side is constant.

    Constancy is tested by minimum = maximum: the variance of a constant that
    binary fractions cannot hold (0.1) may come out as a tiny number instead
    of zero, depending on how the rows are partitioned.  Spark runs ANSI,
    where ``corr`` divides by a zero variance and fails the job, so the ratio
    goes through ``try_divide``.
    """
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    varies = (F.min(xs) < F.max(xs)) & (F.min(ys) < F.max(ys))
    return F.when(varies, F.try_divide(F.covar_pop(xs, ys), F.sqrt(F.var_pop(xs) * F.var_pop(ys))))
