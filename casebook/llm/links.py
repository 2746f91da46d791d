"""Connected components of a link table, and joins whose small side is checked before it is broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm._common import cut

# Rows of a few numbers each: some 20 MB. Beyond it the join is an ordinary shuffle join.
BROADCAST_ROWS = 500_000


def join_checked(left: DataFrame, right: DataFrame, rows: int, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Joins with ``right``, broadcast only if its counted ``rows`` are few; the result is the same either way."""
    return left.join(F.broadcast(right) if rows <= BROADCAST_ROWS else right, list(on), how)


def _stars(edges: DataFrame) -> bool:
    """Whether the links form stars: every ``a`` has one ``b``, and no ``b`` is an ``a``."""
    heads = edges.select(F.col("b").alias("a")).distinct().withColumn("h", F.lit(1))
    r = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).join(heads, "a", "left").agg(
        F.max("n").alias("n"), F.count("h").alias("h")).first()
    return r.n is None or (r.n == 1 and r.h == 0)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node of the links (a, b); a component is named by its least node.

    Alternating large and small stars: each step links the neighbours of a node to the least of them, by a minimum
    (combined before the shuffle) and a join, so no task gathers the neighbours of a hub. The links of a step are
    written before the next; the number of steps grows with the logarithm of the nodes.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), name)
        large = cut(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                    .distinct(), name)
        low = cut(large.groupBy("a").agg(F.min("b").alias("m")), name)
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = cut(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), name)
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))
