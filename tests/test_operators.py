"""Edge cases of the operators and column functions (semantics register)."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import rows, sortkey_sorted
from pyspark.sql import Window
from pyspark.sql import functions as F

from casebook.functions import (
    bucket_label,
    exact_round_ratio,
    list_length,
    null_sentinels,
    parse_int_list,
    strip_units,
    week_of_month,
    width_bucket,
)
from casebook.functions.text import EXCLUSION_SENTINELS, EXTRA_SENTINELS
from casebook.operators import (
    along,
    attach_scalars,
    dense_index,
    explode_list,
    pick_ranked,
    rank_by_histogram,
    state_at,
    stepped_dates,
    top_with_ties,
)
from casebook.plans import ingredients, pricing

D = dt.date.fromisoformat


def test_nan_guarded_for_extras_only(spark):
    df = spark.createDataFrame([("NaN", "NaN"), ("", "null"), (None, None)], "exclusions string, extras string")
    got = rows(df.select(null_sentinels("exclusions", EXCLUSION_SENTINELS).alias("e"),
                         null_sentinels("extras", EXTRA_SENTINELS).alias("x")))
    assert got == sortkey_sorted([("NaN", None), (None, None), (None, None)])


def test_strip_units(spark):
    df = spark.createDataFrame([("20km",), ("23.4 km",), ("23.4",), ("null",), ("15 minute",), ("10minutes",)], "s string")
    got = [r[0] for r in df.select(strip_units("s")).collect()]
    assert got == [Decimal("20.00"), Decimal("23.40"), Decimal("23.40"), None, Decimal("15.00"), Decimal("10.00")]


def test_list_parsing_and_explode(spark):
    df = spark.createDataFrame([(1, "1, 5"), (2, None), (3, "4")], "id int, extras string")
    assert rows(explode_list(df, "extras", "x", keep=["id"])) == [(1, 1), (1, 5), (3, 4)]
    assert rows(explode_list(df, "extras", "x", keep=["id"], outer=True)) == sortkey_sorted(
        [(1, 1), (1, 5), (2, None), (3, 4)])
    assert [r[0] for r in df.select(list_length("extras")).collect()] == [2, None, 1]
    assert df.select(parse_int_list("extras")).schema[0].dataType.simpleString() == "array<int>"


def test_revenue_with_extras_null_when_no_extras(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "pizza_id int, extras string")
    assert rows(pricing.revenue_with_extras(df, F.col("pizza_id") == 1)) == [(None,)]


def test_union_distinct_collapses_equal_pairs(spark):
    orders = spark.createDataFrame([(1, None, None), (2, None, None)], "pizza_id int, exclusions string, extras string")
    recipes = spark.createDataFrame([(1, "7"), (2, "7")], "pizza_id int, toppings string")
    assert rows(ingredients.ingredient_totals(orders, recipes)) == [(7, 1)]
    assert rows(ingredients.ingredient_totals(orders, recipes, union_all=True)) == [(7, 2)]


def test_month_steps_drift_like_generate_series(spark):
    df = spark.createDataFrame([(D("2020-01-31"), D("2020-06-30"), 1), (D("2020-02-29"), D("2022-03-01"), 12),
                                (D("2021-03-01"), D("2020-12-31"), 12)], "s date, e date, step int")
    got = [r[0] for r in df.select(stepped_dates("s", "e", F.col("step"))).collect()]
    assert got[0] == [D(x) for x in ("2020-01-31", "2020-02-29", "2020-03-29", "2020-04-29", "2020-05-29", "2020-06-29")]
    assert got[1] == [D("2020-02-29"), D("2021-02-28"), D("2022-02-28")]
    assert got[2] == []  # start after stop: no dates, no error


def test_width_bucket_and_labels(spark):
    df = spark.createDataFrame([(0,), (30,), (359,), (360,), (-1,)], "x int")
    got = [tuple(r) for r in df.select(width_bucket("x", 0, 360, 12).alias("b"),
                                       bucket_label(width_bucket("x", 0, 360, 12), 30)).collect()]
    assert got == [(1, "0-30"), (2, "30-60"), (12, "330-360"), (13, "360-390"), (0, "-30-0")]


def test_week_of_month(spark):
    df = spark.createDataFrame([(D("2021-01-01"),), (D("2021-01-07"),), (D("2021-01-08"),), (D("2021-01-15"),)], "d date")
    assert [r[0] for r in df.select(week_of_month("d")).collect()] == ["1", "1", "2", "3"]


def test_exact_round_ratio_half_away_from_zero(spark):
    df = spark.createDataFrame([(1, 8), (-1, 8), (2, 3), (1673, 100), (5, 0)], "n long, d long")
    got = [r[0] for r in df.select(exact_round_ratio("n", "d", 2)).collect()]
    assert got == [Decimal("0.13"), Decimal("-0.13"), Decimal("0.67"), Decimal("16.73"), None]


def test_top_with_ties(spark):
    df = spark.createDataFrame([("a", 3), ("b", 3), ("c", 1)], "k string, n int")
    assert rows(top_with_ties(df, "n")) == [("a", 3), ("b", 3)]
    g = spark.createDataFrame([(1, "a", 2), (1, "b", 2), (2, "c", 1), (2, "d", 5)], "g int, k string, n int")
    assert rows(top_with_ties(g, "n", keys=["g"])) == [(1, "a", 2), (1, "b", 2), (2, "d", 5)]


def test_pick_ranked_keeps_ties(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 1, "y"), (1, 2, "z"), (2, 5, "w")], "k int, t int, v string")
    assert rows(pick_ranked(df, ["k"], ["t"])) == [(1, 1, "x"), (1, 1, "y"), (2, 5, "w")]
    assert rows(pick_ranked(df, ["k"], [("t", False)])) == [(1, 2, "z"), (2, 5, "w")]


def test_rank_by_histogram_equals_rank(spark):
    random.seed(3)
    data = [(random.randint(0, 3), random.randint(0, 9)) for _ in range(300)]
    df = spark.createDataFrame(data, "k int, t int")
    ours = rows(rank_by_histogram(df, ["k"], "t", "r"))
    ref = rows(df.withColumn("r", F.rank().over(Window.partitionBy("k").orderBy("t"))))
    assert ours == ref


def test_dense_index_equals_dense_rank(spark):
    words = spark.createDataFrame([(w,) for w in "pear apple fig apple kiwi date fig".split()], "w string")
    ours = rows(dense_index(words, "w", "i", partitions=3))
    assert ours == [("apple", 1), ("date", 2), ("fig", 3), ("kiwi", 4), ("pear", 5)]


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_along_split_equals_window_under_skew(spark, parts):
    random.seed(parts)
    data, eid = [], 0
    for k, n in [(1, 700), (2, 2), (3, 1), (4, 90)] + [(10 + i, random.randint(1, 4)) for i in range(40)]:
        for _ in range(n):
            data.append((k, random.randint(0, 30), eid, random.randint(0, 5), D("2020-01-01") + dt.timedelta(days=eid % 40)))
            eid += 1
    df = spark.createDataFrame(data, "k long, t long, id long, v int, d date")
    kw = dict(lead={"nv": "v", "nd": "d"}, lag={"pv": "v"}, row_number="rn")
    a = rows(along(df, ["k"], ["t", "id"], method="split", partitions=parts, **kw))
    b = rows(along(df, ["k"], ["t", "id"], method="window", **kw))
    assert a == b


def test_along_multiple_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        data = [(k, t, t * 10 + k) for k in (1, 2, 3) for t in range(25)]
        df = spark.createDataFrame(data, "k long, t long, v long")
        kw = dict(lead={"nv": "v"}, lag={"pv": "v"}, row_number="rn")
        assert rows(along(df, ["k"], ["t"], method="split", partitions=2, **kw)) == rows(
            along(df, ["k"], ["t"], method="window", **kw))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_state_at(spark):
    df = spark.createDataFrame([(D("2020-12-31"), None), (D("2020-12-01"), D("2020-12-31")), (D("2020-11-01"), None)],
                               "s date, n date")
    at = F.lit("2020-12-31").cast("date")
    strict = [r[0] for r in df.select(state_at(at, "s", "n")).collect()]
    left = [r[0] for r in df.select(state_at(at, "s", "n", closed="left")).collect()]
    assert strict == [False, False, True] and left == [True, False, True]


def test_attach_scalars_uses_a_scalar_subquery(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    total = df.agg(F.sum("a").alias("t"))
    out = attach_scalars(df, total)
    assert rows(out) == [(1, 3), (2, 3)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan and "Join" not in plan


def test_sinks_append_replace_freeze(spark):
    import tempfile

    from casebook.sources import sinks

    folder = tempfile.mkdtemp(prefix="casebook-sink-")
    path = f"{folder}/names"
    names = spark.createDataFrame([(1, "a"), (2, "b")], "pizza_id int, pizza_name string")
    sinks.replace(names, path)
    sinks.append(spark.createDataFrame([(3, "c")], names.schema), path)
    assert rows(sinks.read_back(names, path)) == [(1, "a"), (2, "b"), (3, "c")]
    sinks.replace(names, path)
    assert rows(sinks.read_back(names, path)) == [(1, "a"), (2, "b")]
    frozen = sinks.freeze(names.filter(F.col("pizza_id") > 1), "test")
    assert rows(frozen) == [(2, "b")]
    assert "FileScan parquet" in frozen._jdf.queryExecution().executedPlan().toString()


def test_zip_lists_pads_with_null(spark):
    from casebook.operators import zip_lists

    df = spark.createDataFrame([(1, "1, 5", "4"), (2, None, None), (3, None, "2, 6")], "id int, extras string, exclusions string")
    got = rows(zip_lists(df, "extras", "exclusions", "extra_id", "exclusion_id", keep=["id"]))
    assert got == sortkey_sorted([(1, 1, 4), (1, 5, None), (2, None, None), (3, None, 2), (3, None, 6)])


def test_elapsed_minutes_drops_whole_days(spark):
    from casebook.functions import elapsed_minutes

    df = spark.createDataFrame([(dt.datetime(2021, 1, 1, 10, 0, 0), dt.datetime(2021, 1, 2, 10, 30, 30))],
                               "a timestamp_ntz, b timestamp_ntz")
    got = df.select(elapsed_minutes("b", "a").alias("m"), elapsed_minutes("b", "a", include_days=True).alias("d")).first()
    assert got["m"] == 30.5 and got["d"] == 1470.5


def test_sql_over_registered_fixtures(spark):
    from casebook.sources.catalog import register_fixtures

    register_fixtures(spark)
    got = rows(spark.sql(
        "SELECT s.customer_id, SUM(m.price) AS amount_spent FROM sales s JOIN menu m USING (product_id) "
        "GROUP BY s.customer_id"))
    assert got == [("A", 76), ("B", 74), ("C", 36)]


def test_hot_key_is_spread_over_range_partitions(spark):
    """A key holding a third of the rows lands in several partitions, none oversized."""
    from casebook.operators._sizing import partitions_for

    n_rows, parts = 6000, 8
    data = [(0 if i % 3 == 0 else i, i) for i in range(n_rows)]  # key 0: a third of all rows
    df = spark.createDataFrame(data, "k long, t long")
    split = df.repartitionByRange(parts, "k", "t").withColumn("p", F.spark_partition_id())
    per_part = {r["p"]: r["n"] for r in split.groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()}
    hot_parts = split.filter(F.col("k") == 0).select("p").distinct().count()
    assert hot_parts >= 2
    assert max(per_part.values()) <= 2 * n_rows / parts
    assert partitions_for(df) >= 1


def test_along_property_random_layouts(spark):
    """split == window over random key skews, NULL keys and order values, ties and partition counts."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    rowsets = st.lists(
        st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(0, 6)), st.integers(-5, 5)),
        min_size=1, max_size=60,
    )

    @settings(max_examples=12, deadline=None, derandomize=True, database=None, suppress_health_check=list(HealthCheck))
    @given(rowsets, st.integers(1, 9))
    def check(data, parts):
        with_id = [(k, t, i, v) for i, (k, t, v) in enumerate(data)]
        df = spark.createDataFrame(with_id, "k int, t int, id int, v int")
        kw = dict(lead={"nv": "v"}, lag={"pv": "v"}, row_number="rn")
        a = rows(along(df, ["k"], ["t", "id"], method="split", partitions=parts, **kw))
        b = rows(along(df, ["k"], ["t", "id"], method="window", **kw))
        assert a == b

    check()


def test_checkpoint_dir_comes_from_the_session(spark):
    from casebook.session import ensure_checkpoint_dir

    configured = spark.conf.get("spark.checkpoint.dir")
    assert ensure_checkpoint_dir(spark) == configured
    assert spark.sparkContext.getCheckpointDir() is not None


def test_range_operators_on_empty_input(spark):
    empty = spark.createDataFrame([], "k long, t long, v int")
    out = along(empty, ["k"], ["t"], lead={"nv": "v"}, lag={"pv": "v"}, row_number="rn", method="split", partitions=4)
    assert out.columns == ["k", "t", "v", "nv", "pv", "rn"] and out.count() == 0
    words = spark.createDataFrame([], "w string")
    assert dense_index(words, "w", "i", partitions=3).count() == 0


def _add_months(d: dt.date, months: int) -> dt.date:
    import calendar

    m = d.month - 1 + months
    y, m = d.year + m // 12, m % 12 + 1
    return dt.date(y, m, min(d.day, calendar.monthrange(y, m)[1]))


def test_stepped_dates_property(spark):
    """The fold equals stepping from the previous date (clamped at month ends), stop inclusive."""
    random.seed(11)
    cases = []
    for _ in range(300):
        start = dt.date(2019, 1, 1) + dt.timedelta(days=random.randint(0, 900))
        if random.random() < 0.4:  # favour month ends
            start = _add_months(start.replace(day=1), 1) - dt.timedelta(days=random.randint(1, 3))
        span = random.choice([1200, 1200, 40000])  # up to a century
        stop = start + dt.timedelta(days=random.randint(-40, span))
        cases.append((start, stop, random.choice([1, 1, 12, 12, 3, 5])))
    for step in range(1, 97):  # every step up to eight years, over two centuries from a leap day
        cases.append((dt.date(1904, 2, 29), dt.date(2104, 3, 1), step))
    df = spark.createDataFrame(cases, "s date, e date, step int")
    got = [r[0] for r in df.select(stepped_dates("s", "e", F.col("step"))).collect()]
    for (s, e, step), dates in zip(cases, got):
        expected, d = [], s
        while d <= e:
            expected.append(d)
            d = _add_months(d, step)
        assert dates == expected, (s, e, step)


def test_exact_round_ratio_near_half(spark):
    cases = [(5000, 1000001), (50000, 10000001), (500, 100001), (5, 1000), (-5, 1000), (1, 3), (10**17, 3), (None, 3), (1, 0), (0, 7)]
    df = spark.createDataFrame([(i, n, d) for i, (n, d) in enumerate(cases)], "i int, n long, d long")
    got = {r.i: r.q for r in df.select("i", exact_round_ratio("n", "d", 2).alias("q")).collect()}
    for i, (n, d) in enumerate(cases):
        if n is None or not d:
            assert got[i] is None
        else:
            want = (Decimal(n) / Decimal(d)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
            assert got[i] == want, cases[i]


def test_histogram_labels_start_at_lo(spark):
    from casebook.plans.subscriptions import upgrade_histogram

    subs = spark.createDataFrame([(1, 0, D("2020-01-01")), (1, 3, D("2020-01-16"))], "customer_id int, plan_id int, start_date date")
    assert [tuple(r) for r in upgrade_histogram(subs, lo=10, hi=40, buckets=3).collect()] == [("10-20", 1)]
    with pytest.raises(ValueError):
        upgrade_histogram(subs, lo=0, hi=100, buckets=7)


def test_null_customers_and_no_rows(spark):
    from casebook.plans.subscriptions import churn_percent, days_to_upgrade

    schema = "customer_id int, plan_id int, start_date date"
    some = spark.createDataFrame([(1, 4, D("2020-01-01")), (2, 0, D("2020-01-01")), (None, 4, D("2020-01-01")),
                                  (None, 0, D("2020-01-01")), (None, 3, D("2020-03-01"))], schema)
    assert [tuple(r) for r in churn_percent(some).collect()] == [(1, 50.0)]
    assert churn_percent(some.limit(0)).collect()[0].churned_customers == 0
    assert days_to_upgrade(some).collect()[0].mean_days is None


def test_list_separator_is_no_pattern(spark):
    df = spark.createDataFrame([("a|b",)], "t string")
    assert [r.x for r in explode_list(df, "t", "x", sep="|", element_type="string").collect()] == ["a", "b"]


def test_stable_rating_of_negative_ids(spark):
    from casebook.functions.numeric import stable_rating

    df = spark.createDataFrame([(-3, 1), (3, 1), (-7, -9)], "o long, r long")
    assert all(1 <= x.s <= 5 for x in df.select(stable_rating("o", "r").alias("s")).collect())


def test_along_takes_any_date_and_big_numbers(spark):
    data = [(1, D("2020-01-01"), 2**60 + 1), (1, D("9999-12-31"), None), (None, D("0001-01-01"), 2**53 + 1), (None, D("9999-12-31"), 7)]
    df = spark.createDataFrame(data, "k long, t date, v long").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    kw = dict(lead={"nv": "v", "nt": "ts"}, lag={"pv": "v"})
    assert rows(along(df, ["k"], ["t"], method="split", partitions=3, **kw)) == rows(along(df, ["k"], ["t"], method="window", **kw))


@pytest.mark.parametrize("parts", [1, 5])
def test_running_sum_equals_window(spark, parts):
    random.seed(parts)
    data = [(random.choice([0, 0, 1, 2, None]), i, random.randint(0, 9)) for i in range(300)]
    df = spark.createDataFrame(data, "k long, t long, n long")
    split, window = (along(df, ["k"], ["t"], running=("upto", "n"), method=m, partitions=parts if m == "split" else None)
                     for m in ("split", "window"))
    assert rows(split) == rows(window)


def test_cluster_without_shared_folder_is_refused():
    from casebook import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Fake:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Fake())
