"""Month series in closed form (D12, L9) against stepping date by date."""

import calendar as days_of
import datetime as dt
import os
import random
import time

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from casebook.operators import calendar, date_at, dates_until, expand_calendar, stepped_dates

ROWS = "s date, e date, step int"


def stepping(start, stop, step):
    """Each date from the one before; a day that a month does not have becomes its last."""
    out, d = [], start
    while d <= stop:
        out.append(d)
        m = d.year * 12 + d.month - 1 + step
        y, month = divmod(m, 12)
        if y > 9999:
            break
        d = dt.date(y, month + 1, min(d.day, days_of.monthrange(y, month + 1)[1]))
    return out


def sample():
    rng = random.Random(5)
    rows = []
    for _ in range(1500):
        y, m = rng.choice([1895, 1896, 1899, 1996, 1999, 2000, 2003, 2004, 2096, 2099, 2103]), rng.randrange(1, 13)
        start = dt.date(y, m, rng.choice([1, 15, 27, days_of.monthrange(y, m)[1], min(29, days_of.monthrange(y, m)[1])]))
        rows.append((start, start + dt.timedelta(days=rng.choice([-400, -1, 0, 1, 27, 28, 31, 400, 3000, 15_000, 160_000])),
                     rng.choice([1, 2, 3, 4, 5, 6, 7, 11, 12, 13, 18, 24, 36, 48, 60, 96, 1200, 4800])))
    leap = dt.date(1896, 2, 29)
    rows += [(leap, dt.date(2500, 1, 1), s) for s in (12, 24, 36, 48, 96, 192, 240, 400, 480, 1200, 2400, 4800, 9600)]
    return rows


def test_series_match_stepping(spark):
    rows = sample()
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ROWS).repartition(4)
    counted = calendar("s", "step")
    got = {r.i: (r.d, r.n) for r in df.select("i", stepped_dates("s", "e", "step").alias("d"), dates_until(counted, "e").alias("n")).collect()}
    for i, row in enumerate(rows):
        want = stepping(*row)
        assert got[i] == (want, len(want)), row
    expanded = expand_calendar(df, "s", "e", "step", out="d").groupBy("i").agg(F.sort_array(F.collect_list("d")).alias("d")).collect()
    assert {r.i: r.d for r in expanded} == {i: d for i, (d, n) in got.items() if n}


def test_any_date_without_the_others(spark):
    df = spark.range(1).select(calendar(F.lit("2020-01-31").cast("date"), F.lit(1)).alias("c"))
    got = df.select(*[date_at(F.col("c"), F.lit(k).cast("long")) for k in (0, 1, 2, 13, 24)]).first()
    assert [str(d) for d in got] == ["2020-01-31", "2020-02-29", "2020-03-29", "2021-02-28", "2022-01-28"]


def test_null_and_wrong_steps(spark):
    day = dt.date(2020, 1, 31)
    df = spark.createDataFrame([(None, day, 1), (day, None, 1), (day, day, None)], ROWS)
    assert [r[0] for r in df.select(stepped_dates("s", "e", "step")).collect()] == [[], [], []]
    assert expand_calendar(df, "s", "e", "step").count() == 0
    for step in (0, -1):
        with pytest.raises(Exception, match="one month at least"):
            spark.createDataFrame([(day, day, step)], ROWS).select(stepped_dates("s", "e", "step")).collect()


def test_a_long_series_takes_linear_time(spark):
    """100,000 months in one row; a quadratic fold would take some 10^10 steps."""
    df = spark.createDataFrame([(dt.date(1, 1, 31), dt.date(8400, 1, 1), 1)], ROWS)
    begun = time.monotonic()
    r = df.select(F.size(stepped_dates("s", "e", "step")).alias("n"), dates_until(calendar("s", "step"), "e").alias("m")).first()
    assert r.n == r.m == 8399 * 12 and time.monotonic() - begun < 30


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="generated tables not present")
def test_payments_have_no_date_array(spark):
    from casebook.plans.catalog import QUERIES

    df = QUERIES["payments"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode(") == 1 and "make_date" in plan.split("Generate explode(")[0]
    assert "make_date" not in plan.split("Generate explode(")[1]
