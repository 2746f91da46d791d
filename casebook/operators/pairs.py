"""Statistics over all pairs of two slices of one table, without making the pairs.

The source joins a table with itself: rows where ``left`` holds with rows of the same key where ``right`` holds, every one
with every one, and looks at the difference of a whole-number ``value`` (right minus left). A key with n rows on each side has n * n
pairs, so the join's work grows with the square of a key's rows. What the jobs report can be had from counts:

``pair_totals``
    Per key the number of rows and the sum of the values of each side (partial aggregates). The pairs are a product of counts, and
    their differences add up to n_left * sum_right - n_right * sum_left.

``pair_histogram``
    Pairs whose difference is below an edge e: for each left value v, the right rows of the key below v + e. Equal values of a key
    are counted first; then the right values and, for each edge, the left values moved by it stand in one sequence by position,
    and the running sum of right counts (``along``) meets each moved left value with the number wanted. The sequence is cut into ranges of
    (key, position), so a key with a third of all rows spans tasks.

Rows whose key is NULL take no part, as in a join; a pair with a NULL value has no difference: it is counted as a pair only.
Counts of pairs and sums are decimal(38,0): a key with 10^10 rows has 10^20 pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.operators.sequence import along
from casebook.operators.shares import attach_scalars

_BIG = "decimal(38,0)"


def _times(a: str, b: str) -> Column:
    """A product of two 64-bit numbers, exact."""
    return F.col(a).cast("decimal(19,0)") * F.col(b).cast("decimal(19,0)")


def _total(column: Column) -> Column:
    return F.coalesce(F.sum(column.cast(_BIG)), F.lit(0).cast(_BIG)).cast(_BIG)


def pair_totals(df: DataFrame, key: str, value: Column, left: Column, right: Column) -> DataFrame:
    """One row: all ``pairs``, those with a difference (``known``), and the ``total`` of the differences."""
    sides = df.where(F.col(key).isNotNull() & (left | right)).select(F.col(key).alias("k"), value.cast("long").alias("v"),
                                                                     left.alias("l"), right.alias("r"))
    known = F.col("v").isNotNull()
    per = sides.groupBy("k").agg(
        F.count(F.when(F.col("l"), 1)).alias("l"), F.count(F.when(F.col("r"), 1)).alias("r"),
        F.count(F.when(F.col("l") & known, 1)).alias("lk"), F.count(F.when(F.col("r") & known, 1)).alias("rk"),
        F.coalesce(F.sum(F.when(F.col("l"), F.col("v"))), F.lit(0)).alias("ls"),
        F.coalesce(F.sum(F.when(F.col("r"), F.col("v"))), F.lit(0)).alias("rs"),
    )
    return per.agg(
        _total(_times("l", "r")).alias("pairs"), _total(_times("lk", "rk")).alias("known"),
        (_total(_times("lk", "rs")) - _total(_times("rk", "ls"))).cast(_BIG).alias("total"),
    )


def pairs_below(df: DataFrame, key: str, value: Column, left: Column, right: Column, edges: Sequence[int],
                method: str = "split") -> DataFrame:
    """One row: ``below_0``, ``below_1``, ...: the pairs whose difference is below each edge."""
    counted = df.where(F.col(key).isNotNull() & (left | right)).select(
        F.col(key).alias("k"), value.cast("long").alias("v"), left.alias("l"), right.alias("r")
    ).where("v IS NOT NULL").groupBy("k", "v").agg(
        F.count(F.when(F.col("l"), 1)).alias("l"), F.count(F.when(F.col("r"), 1)).alias("r"))
    # A left value moved by an edge comes before the right value at the same place: only smaller ones are below the edge.
    at = lambda place, side, edge, n, w: F.struct(
        place.alias("place"), F.lit(side).alias("side"), F.lit(edge).alias("edge"), n.alias("n"), w.alias("w"))
    none = F.lit(0).cast("long")
    moved = [at(F.col("v") + F.lit(e).cast("long"), 0, i, F.col("l"), none) for i, e in enumerate(edges)]
    placed = counted.select("k", F.explode(F.filter(F.array(at(F.col("v"), 1, -1, none, F.col("r")), *moved),
                                                    lambda s: (s["n"] + s["w"]) > 0)).alias("s")).select("k", "s.*")
    met = along(placed, ["k"], ["place", "side", "edge"], running=("upto", "w"), method=method)
    return met.agg(*[_total(F.when(F.col("edge") == i, _times("n", "upto"))).alias(f"below_{i}") for i in range(len(edges))])


def pair_histogram(df: DataFrame, key: str, value: Column, left: Column, right: Column, edges: Sequence[int],
                   method: str = "split") -> DataFrame:
    """(bucket, pairs) of all buckets that have pairs: 0 below the first edge, i from edge i - 1 to below edge i, the number
    of edges at or beyond the last; NULL for pairs without a difference."""
    edges = list(edges)
    if not edges or edges != sorted(set(edges)):
        raise ValueError("edges must ascend")
    below = attach_scalars(pairs_below(df, key, value, left, right, edges, method), pair_totals(df, key, value, left, right).drop("total"))
    last = len(edges) - 1
    parts = [F.col("below_0")] + [F.col(f"below_{i}") - F.col(f"below_{i - 1}") for i in range(1, last + 1)]
    parts += [F.col("known") - F.col(f"below_{last}"), F.col("pairs") - F.col("known")]
    names = [F.lit(i) for i in range(last + 2)] + [F.lit(None).cast("int")]
    rows = F.array(*[F.struct(b.alias("bucket"), p.cast(_BIG).alias("pairs")) for b, p in zip(names, parts)])
    return below.select(F.explode(rows).alias("s")).select("s.*").where("pairs > 0")
