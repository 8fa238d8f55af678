"""Connected components of an edge table, as a few Spark joins per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripscope.llm.common import stored

MAX_ROUNDS = 60


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from each node that an
    edge (a, b) names.

    Alternating large-star and small-star steps.  Each is a group-by-minimum
    (combined before its shuffle, so a node with very many edges stays one
    number) joined back to its edges; the rounds, about the logarithm of the
    longest chain, end when no edge changes.  Every step is written out and
    reread, so no lineage grows and a lost executor costs one reread.
    """

    def star(links: DataFrame, larger: bool) -> DataFrame:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        if larger:  # neighbours above a node hang on its lowest neighbour
            hung = both.where("b > a")
            return hung.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # neighbours below a node, and the node, hang on the lowest of them
        hung = both.where("b < a").join(lowest, "a")
        return (
            hung.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(lowest.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct()
        )

    def summary(links: DataFrame) -> tuple:
        row = links.agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")
        ).first()
        return row["n"], row["x"]

    links = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(),
        "links",
    )
    before = summary(links)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        links = stored(star(star(links, True), False), "links")
        now = summary(links)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
