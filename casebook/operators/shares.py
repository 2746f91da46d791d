"""Share of a total.

The source attaches a one-row total with a comma (cross) join. Here the
one-row aggregate becomes a scalar subquery: Spark runs it once as its own
small job and uses the value as a constant in the outer plan, so no join
(cartesian or otherwise) is planned and nothing but one row is moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions._util import as_col


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row aggregate to every row of ``df``."""
    cols = one_row.columns
    packed = one_row.select(F.struct(*cols).alias("_s")).scalar()
    return df.select("*", *[packed.getField(c).alias(c) for c in cols])


def percent_of(part, total) -> Column:
    """part / total * 100 in double precision, as ``x::FLOAT / y::FLOAT * 100``; NULL of a zero total."""
    return F.try_divide(as_col(part).cast("double"), as_col(total).cast("double")) * 100.0


def round_percent(part, total, scale: int = 2) -> Column:
    """ROUND(CAST(part::FLOAT / total::FLOAT * 100 AS NUMERIC), scale).

    The double is first fixed to six decimals, then rounded half-up as a
    decimal, so the result does not depend on how an engine rounds doubles.
    """
    return F.round(percent_of(part, total).cast("decimal(18,6)"), scale).cast(f"decimal(18,{scale})")
