"""Distinct counts from mergeable sketches (the opt-in beside the exact G4 and G5).

An exact COUNT(DISTINCT) of a long period reads and shuffles all its keys each time. A HyperLogLog sketch is a few kilobytes
whatever it has counted, and sketches of parts merge to the sketch of the whole. So one row per group and day is kept
(``daily_sketches``), and any period is a merge of its days (``merged_count``): each task sends one sketch per group, not its keys.
The relative standard error is 1.04 / sqrt(2 ** lg_k), 1.6 % for the default; NULL keys are not counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 12


def error_bound(lg_k: int = LG_K, deviations: float = 4.0) -> float:
    """The relative error that an estimate stays within, but for a chance of some 1 in 10,000 at 4 deviations."""
    return deviations * 1.04 / 2 ** (lg_k / 2)


def daily_sketches(df: DataFrame, key: str, ts: str, by: Sequence[str] = (), lg_k: int = LG_K) -> DataFrame:
    """(by, day, n, sketch): rows and the sketch of their keys, per group and day."""
    return df.groupBy(*by, F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(key, lg_k).alias("sketch"))


def merged_count(sketches: DataFrame, by: Sequence[str] = (), days: Column | None = None, out: str = "customers") -> DataFrame:
    """Distinct keys of the days where ``days`` holds, per group; 0 without rows."""
    rows = sketches if days is None else sketches.filter(days)
    return rows.groupBy(*by).agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias(out))
