"""Membership flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flag_since(df: DataFrame, since: DataFrame, key: str, date_col: str, since_col: str, out: str = "member") -> DataFrame:
    """Left-join ``since`` on ``key`` and flag 'Y' when ``date_col >= since_col``.

    A row with no match compares against NULL, which is not true, so it gets
    'N' (CASE semantics). ``since`` has one row per key (a dimension or an
    aggregate); AQE broadcasts it when it is measured small.
    """
    s = since.select(F.col(key).alias("_k"), F.col(since_col).alias("_since"))
    joined = df.join(s, df[key] == s["_k"], "left")
    flagged = joined.withColumn(out, F.when(F.col(date_col) >= F.col("_since"), F.lit("Y")).otherwise(F.lit("N")))
    return flagged.drop("_k", "_since")
