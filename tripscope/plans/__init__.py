"""Named analyses (the catalogue), their SQL twins, and plan checks."""

from tripscope.plans.catalog import QUERY_FUNCTIONS, queries, round_doubles
from tripscope.plans.oracle import oracle_sql

__all__ = ["QUERY_FUNCTIONS", "oracle_sql", "queries", "round_doubles"]
