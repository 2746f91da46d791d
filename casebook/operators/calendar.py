"""Calendar expansion.

``generate_series(start, stop, interval)`` for month-based steps, stop
inclusive, one output row per date. Each date is the previous date plus the
step, so a day clamped at a month end stays clamped: 31 Jan, 29 Feb, 29 Mar.
(``sequence`` with an interval keeps the anchor day: 31 Mar.)

The day of the k-th date is the start day, capped by the shortest month among steps 1..k. That cap falls at most three
times: to 30, 29 and 28, each at the first step that meets a month that short. These three steps follow from the start month and
the step alone (``calendar``): months repeat after 12 steps at most, and of the Februaries met, the second is not a leap one unless their years
are 4 apart, or a multiple of it, where the next century year decides. So every date (``date_at``) and the number of
dates up to a day (``dates_until``) are a few operations, however many steps lie between, and no date depends on another one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions._util import as_col

SHORT = (1, 3, 5, 8, 10)  # fixed values: months of 30 days or less, counted from 0
FEBRUARY = 1


def _first_step(months: tuple[int, ...]) -> list[int]:
    """For start month m and step s (mod 12), at m * 12 + s: the first step that meets one of ``months``; 0 if none does."""
    return [next((j for j in range(1, 13) if (m + j * s) % 12 in months), 0) for m in range(12) for s in range(12)]


def _whole(x: Column, y: Column | int) -> Column:
    return F.call_function("div", x.cast("long"), y if isinstance(y, Column) else F.lit(y))


def _leap(year: Column) -> Column:
    return (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), 0)


def calendar(start, step_months) -> Column:
    """struct(month, day, step, to30, to29, to28) of a series: its start, and the steps from which days are capped (NULL: never).

    Months count from year 0. NULL for a NULL start or step; a step below 1 is an error.
    """
    s = as_col(start).cast("date")
    step = as_col(step_months).cast("long")
    step = F.when(step < 1, F.raise_error(F.lit("a calendar step is one month at least")).cast("long")).otherwise(step)
    month = (F.year(s) * 12 + F.month(s) - 1).cast("long")

    def first(months: tuple[int, ...], c: Column) -> Column:
        table = F.array(*[F.lit(x) for x in _first_step(months)])
        return F.nullif(F.get(table, ((c["month"] % 12) * 12 + c["step"] % 12).cast("int")), F.lit(0)).cast("long")

    def not_leap(c: Column) -> Column:
        """The first February met whose year is no leap year."""
        common = F.element_at(F.array(*[F.lit(math.gcd(r, 12)) for r in range(12)]), (c["step"] % 12 + 1).cast("int"))
        every, years = _whole(F.lit(12), common), _whole(c["step"], common)  # steps and years from one February to the next
        year = _whole(c["month"] + c["to29"] * c["step"], 12)
        century = F.get(F.filter(F.sequence(F.lit(0).cast("long"), F.lit(99).cast("long")), lambda i: ~_leap(year + i * years)), 0)
        after = F.when(~_leap(year), F.lit(0).cast("long")).when(years % 4 != 0, F.lit(1).cast("long")).otherwise(century)
        return c["to29"] + every * after

    made = F.struct(month.alias("month"), F.dayofmonth(s).alias("day"), step.alias("step"))
    made = _bind(made, lambda c: F.struct(c["month"].alias("month"), c["day"].alias("day"), c["step"].alias("step"),
                                          first(SHORT, c).alias("to30"), first((FEBRUARY,), c).alias("to29")))
    made = _bind(made, lambda c: F.struct(*[c[n].alias(n) for n in ("month", "day", "step", "to30", "to29")],
                                          F.when(c["day"] > 28, not_leap(c)).alias("to28")))
    return F.when(s.isNotNull() & step.isNotNull(), made)


def _day(c: Column, k: Column) -> Column:
    return F.least(c["day"], F.when(k >= c["to30"], F.lit(30)), F.when(k >= c["to29"], F.lit(29)), F.when(k >= c["to28"], F.lit(28)))


def date_at(series: Column, k: Column) -> Column:
    """The k-th date (from 0) of a :func:`calendar`."""
    month = series["month"] + k * series["step"]
    return F.make_date(_whole(month, 12).cast("int"), (month % 12 + 1).cast("int"), _day(series, k))


def dates_until(series: Column, stop) -> Column:
    """How many dates of a :func:`calendar` are not after ``stop``; NULL if either is NULL."""
    e = as_col(stop).cast("date")
    ahead = (F.year(e) * 12 + F.month(e) - 1).cast("long") - series["month"]
    last = _whole(ahead, series["step"])
    late = (ahead % series["step"] == 0) & (_day(series, last) > F.dayofmonth(e))  # in the month of ``stop``, after it
    return F.when(ahead < 0, F.lit(0).cast("long")).otherwise(last + 1 - late.cast("long"))


def steps(count) -> Column:
    """array<bigint> of 0 .. count - 1; empty for a count of 0 or NULL."""
    n = as_col(count).cast("long")
    return F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<bigint>"))


def stepped_dates(start, stop, step_months) -> Column:
    """array<date> of start, start+step, ... (each from the previous) up to stop; empty for a NULL."""
    return _bind(calendar(start, step_months), lambda c: F.transform(steps(dates_until(c, stop)), lambda k: date_at(c, k)))


def expand_calendar(df: DataFrame, start: str, stop: str, step_months, out: str = "payment_date") -> DataFrame:
    """One row per stepped date in [start, stop]; rows with start > stop give none. The dates are made in the rows they go to."""
    series = df.withColumn("_series", calendar(start, step_months))
    each = series.withColumn("_k", F.explode(steps(dates_until(F.col("_series"), stop))))
    return each.withColumn(out, date_at(F.col("_series"), F.col("_k"))).drop("_series", "_k")
