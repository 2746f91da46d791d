"""Date, time and interval helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebook.functions._util import as_col


def elapsed_minutes(end, start, include_days: bool = False) -> Column:
    """Minutes between two timestamps as a double.

    hours * 60 + minutes + seconds / 60 of the interval ``end - start``. Like
    the source formula, whole days are dropped unless ``include_days``. The
    integral part is summed before the cast, so equal inputs give the same
    double in any engine.
    """
    iv = as_col(end) - as_col(start)
    whole = F.extract(F.lit("HOUR"), iv) * 60 + F.extract(F.lit("MINUTE"), iv)
    if include_days:
        whole = whole + F.extract(F.lit("DAY"), iv) * 1440
    seconds = F.extract(F.lit("SECOND"), iv).cast("double")
    return whole.cast("double") + seconds / 60.0


def elapsed_seconds(end, start) -> Column:
    """D6 without an interval in the output: whole seconds from start to end."""
    return F.timestamp_diff("SECOND", as_col(start), as_col(end))


def week_of_month(d) -> Column:
    """Week of the month as text, days 1-7 -> '1', 8-14 -> '2', ..."""
    return ((F.dayofmonth(as_col(d)) + 6) / 7).cast("int").cast("string")


def weekday_name(ts, pad: bool = False) -> Column:
    """English weekday name; ``pad`` blank-pads to nine characters."""
    name = F.date_format(as_col(ts), "EEEE")
    return F.rpad(name, 9, " ") if pad else name
