"""Ranked picks.

All three operators keep ties, as RANK() = 1 does, and none of them sends a
whole partition key (or the whole table) through one task:

* :func:`pick_ranked` filters on ``rank() <= n``. Catalyst turns that filter
  into a partial ``WindowGroupLimit`` *before* the exchange, so a hot key
  ships only its locally best rows; the final window sorts survivors only.
* :func:`top_with_ties` never ranks at all: an aggregate of the extreme
  value (partial aggregation, one row) is broadcast back as an equi-join key.
* :func:`rank_by_histogram` ranks by counting rows with a smaller
  order value per key, which needs a window over the *distinct* order values
  only (calendar days, not rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.functions._util import as_col
from casebook.operators.sequence import keep


def _order_cols(order: Sequence) -> list[Column]:
    cols = []
    for item in order:
        if isinstance(item, tuple):
            name, ascending = item
            c = as_col(name)
            cols.append(c.asc() if ascending else c.desc())
        else:
            cols.append(as_col(item))
    return cols


SPREAD_ROWS = 1_000_000  # tied rows of a key that one task may get
SPREAD_KEYS = 100_000  # keys with more, at most: the threshold rises with the table, so that this list is bounded


def pick_spread(df: DataFrame, keys: Sequence[str], order: str, ascending: bool = True) -> DataFrame:
    """L3 for rank 1 where a key may have any number of tied rows: the same rows as :func:`pick_ranked`, without a window.

    A rank sends all tied rows of a key to one task, however many there are. Here rows are counted per (keys, order) first, which
    gives each key's best value and its ties. Keys with more than ``SPREAD_ROWS`` ties (or a ``SPREAD_KEYS``-th of all rows, if that is more)
    are at most ``SPREAD_KEYS``: they are broadcast, and their rows are picked where they stand. All others join on (keys, order).
    NULL order values come first ascending and last descending, as in a rank.
    """
    pick = F.min if ascending else F.max
    value = F.struct(F.col(order).isNotNull().alias("known"), F.col(order).alias("value"))
    counts = df.groupBy(*keys, order).agg(F.count(F.lit(1)).alias("_n"))
    best = keep(counts.groupBy(*keys).agg(pick(F.struct(value.alias("v"), F.col("_n").alias("n"))).alias("_b"), F.sum("_n").alias("_all")).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_b.v.value").alias("_best"), F.col("_b.n").alias("_ties"), "_all"), "best")
    total = best.agg(F.coalesce(F.sum("_all"), F.lit(0))).first()[0]
    hot = best.filter(F.col("_ties") > max(SPREAD_ROWS, total // SPREAD_KEYS))
    own = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    picked = F.col(order).eqNullSafe(F.col("_best"))
    if hot.isEmpty():
        return df.join(best, [*own, picked]).select(*df.columns)
    here = df.join(F.broadcast(hot), own, "left")
    spread = here.filter(F.col("_ties").isNotNull() & picked).select(*df.columns)
    others = here.filter(F.col("_ties").isNull()).select(*df.columns)
    return spread.unionByName(others.join(best, [*own, picked]).select(*df.columns))


def pick_ranked(df: DataFrame, keys: Sequence[str], order: Sequence, n: int = 1, rank_col: str | None = None) -> DataFrame:
    """L3: rows whose RANK() within ``keys`` by ``order`` is <= n (ties kept).

    ``order`` items are column names (ascending) or ``(name, ascending)``.
    """
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
    name = rank_col or "_rank"
    ranked = df.withColumn(name, F.rank().over(w)).filter(F.col(name) <= n)
    return ranked if rank_col else ranked.drop(name)


def top_with_ties(df: DataFrame, measure: str, keys: Sequence[str] = (), largest: bool = True) -> DataFrame:
    """L4: rows whose ``measure`` equals the max (or min) of its group.

    With no keys this is RANK() OVER (ORDER BY measure DESC) = 1 without the
    single-task window: the extreme is one row, broadcast as a join key.
    With keys the extremes table has one row per key; AQE broadcasts it when
    it measures small and otherwise joins on (keys, measure), which spreads
    a hot key over its distinct measure values.
    """
    agg = F.max if largest else F.min
    best = df.groupBy(*keys).agg(agg(measure).alias("_best"))
    if not keys:
        return df.join(F.broadcast(best), df[measure] == best["_best"]).drop("_best")
    best = best.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_best")
    cond = [df[k].eqNullSafe(best[f"_k_{k}"]) for k in keys] + [df[measure] == best["_best"]]
    return df.join(best, cond).select(*df.columns)


def rank_by_histogram(df: DataFrame, keys: Sequence[str], order_col: str, out: str, where=None) -> DataFrame:
    """W4 without a per-key sort of all rows: RANK() = 1 + rows with a smaller order value.

    Rows are first counted per (keys, order value) with map-side combining,
    the running count runs over that histogram (one row per distinct order
    value of a key), and the rank is joined back on (keys, order value).
    The result equals RANK() OVER (PARTITION BY keys ORDER BY order_col).
    With ``where``, only matching rows are ranked (among themselves); the
    others get NULL. ``where`` must be constant within a key group.
    """
    ranked_rows = df if where is None else df.filter(where)
    hist = ranked_rows.groupBy(*keys, order_col).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    hist = hist.withColumn(out, (F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1).cast("int"))
    on = [*keys, order_col]
    hist = hist.select(*[F.col(k).alias(f"_k_{k}") for k in on], out)
    cond = [df[k].eqNullSafe(hist[f"_k_{k}"]) for k in on]
    return df.join(hist, cond, "left").select(*df.columns, out)


def dense_index(df: DataFrame, col: str, out: str, partitions: int | None = None) -> DataFrame:
    """Number the distinct values of ``col`` 1, 2, 3, ... in sort order (DENSE_RANK over the whole table).

    A bare ``dense_rank().over(Window.orderBy(col))`` moves every row to one
    task. Here the distinct values are range-partitioned and sorted; each
    partition numbers its own rows, and a table of per-partition counts
    (bounded by the partition count, so it is broadcast) turns local numbers
    into global ones.
    """
    distinct = df.select(col).filter(F.col(col).isNotNull()).distinct()
    # The distinct values are usually far fewer than the scanned rows, so the
    # range exchange takes no fixed count and AQE coalesces it by measured
    # size (merging neighbouring ranges keeps the order). The numbered pass is
    # written once, so every consumer sees the same partitions.
    ranged = distinct.repartitionByRange(partitions, col) if partitions else distinct.repartitionByRange(col)
    values = (
        ranged.sortWithinPartitions(col)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    # Local numbers and per-partition counts must come from one evaluation.
    values = keep(values.withColumn("_local", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)), "dense-index")
    counts = values.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).select("_pid", "_off")
    numbered = values.join(F.broadcast(offsets), "_pid")
    return numbered.select(F.col(col), (F.col("_off") + F.col("_local") + 1).cast("int").alias(out))
