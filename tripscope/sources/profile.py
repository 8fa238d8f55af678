"""A schema print turned into a checkable result: one row per trip column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def source_profile(trips: DataFrame) -> DataFrame:
    """Per column: position, name, Spark type and non-NULL count.

    One aggregate pass computes every count (each task emits one partial row,
    so the shuffle is one row per task), then the single result row is turned
    into one row per column with ``inline``.
    """
    fields = trips.schema.fields
    counts = trips.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(F.col(f"`{f.name}`")).alias(f"__c{i}") for i, f in enumerate(fields)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("ordinal"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f"__c{i}").alias("non_null_count"),
                F.col("__rows").alias("row_count"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return counts.select(F.inline(rows)).orderBy("ordinal")
