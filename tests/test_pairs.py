"""Statistics over all pairs of two slices (N7) against the pairs themselves."""

import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from casebook.operators import pair_histogram, pair_totals
from casebook.operators.pairs import pairs_below
from casebook.plans import subscriptions

ROWS = "k long, v int, side string"


def args():
    return {"key": "k", "value": F.col("v"), "left": F.coalesce(F.col("side").isin("l", "b"), F.lit(False)),
            "right": F.coalesce(F.col("side").isin("r", "b"), F.lit(False))}


def brute(rows, edges):
    left = [(k, v) for k, v, s in rows if s in ("l", "b") and k is not None]
    right = [(k, v) for k, v, s in rows if s in ("r", "b") and k is not None]
    found, known, total, pairs = Counter(), 0, 0, 0
    for k, a in left:
        for m, b in right:
            if k == m:
                pairs += 1
                if a is None or b is None:
                    found[None] += 1
                else:
                    known, total = known + 1, total + b - a
                    found[sum(b - a >= e for e in edges)] += 1
    return dict(found), (pairs, known, total)


def sample(rng, n):
    return [(rng.choice([None, 1, 1, 1, 2, 3, 4, 5, rng.randrange(6, 40)]), rng.choice([None, *range(-5, 60)]),
             rng.choice(["l", "r", "b", None, "x"])) for _ in range(n)]


@pytest.mark.parametrize("method,partitions", [("split", 5), ("window", 2)])
@pytest.mark.parametrize("seed,edges", [(1, [0, 10, 20, 30]), (2, [-7]), (3, [-3, 0, 1, 50])])
def test_pairs_match_the_join(spark, method, partitions, seed, edges):
    rows = sample(random.Random(seed), 500)
    df = spark.createDataFrame(rows, ROWS).repartition(partitions)
    want, totals = brute(rows, edges)
    got = {r.bucket: int(r.pairs) for r in pair_histogram(df, **args(), edges=edges, method=method).collect()}
    assert got == want
    assert tuple(map(int, pair_totals(df, **args()).first())) == totals


def test_no_rows_and_one_side_only(spark):
    df = spark.createDataFrame([(1, 5, "l"), (1, 6, "l"), (2, 7, "r")], ROWS)
    for rows in (df, df.limit(0)):
        assert pair_histogram(rows, **args(), edges=[0, 5]).count() == 0
        assert tuple(pair_totals(rows, **args()).first()) == (0, 0, 0)
    with pytest.raises(ValueError):
        pair_histogram(df, **args(), edges=[5, 0])


def test_more_pairs_than_64_bits(spark):
    """Counts are multiplied, so 6 * 10^9 rows a side need not exist: weights come from equal rows counted once."""
    half = spark.range(3000).select(F.lit(1).cast("long").alias("k"), (F.col("id") % 3).cast("int").alias("v"),
                                    F.when(F.col("id") % 2 == 0, "l").otherwise("r").alias("side"))
    got = {r.bucket: r.pairs for r in pair_histogram(half, **args(), edges=[0]).collect()}
    assert sum(got.values()) == Decimal(1500 * 1500)
    from casebook.operators.pairs import _times

    big = spark.range(1).select(F.lit(6_000_000_000).alias("a"), F.lit(6_000_000_000).alias("b")).select(_times("a", "b").alias("p"))
    assert int(big.first().p) == 36 * 10**18


def test_a_hot_key_spans_partitions(spark, monkeypatch):
    """One key with a third of all rows: its sequence is cut into ranges of (key, place), no task holds all of it."""
    from casebook.operators import sequence

    kept = []
    real = sequence.keep
    monkeypatch.setattr(sequence, "keep", lambda df, name="sequence": kept.append(real(df, name)) or kept[-1])
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("long").alias("k"),
                                    (F.col("id") % 9000).cast("int").alias("v"), F.when(F.col("id") % 2 == 0, "l").otherwise("r").alias("side"))
    pairs_below(df, **args(), edges=[0, 100]).collect()
    per = kept[0].where("k = 7").groupBy("_seq_pid").count().collect()
    total = sum(r["count"] for r in per)
    assert len(per) > 1 and max(r["count"] for r in per) < total


def test_jobs_on_repeated_states(spark):
    """A customer with two trials and three annual plans has six pairs."""
    rows = [(1, 0, "2020-01-01"), (1, 0, "2020-02-01"), (1, 3, "2020-01-11"), (1, 3, "2020-03-01"), (1, 3, "2019-12-31"),
            (2, 0, "2020-05-01"), (2, 1, "2020-05-08"), (None, 0, "2020-01-01"), (None, 3, "2020-01-05"), (3, 0, "2020-01-01"), (3, 3, None)]
    subs = spark.createDataFrame(rows, "customer_id int, plan_id int, start_date string").withColumn("start_date", F.to_date("start_date"))
    days = [10, 60, -1, -21, 29, -32]
    got = subscriptions.days_to_upgrade(subs, pairs="all").first()[0]
    assert got == (Decimal(sum(days)) / len(days)).quantize(Decimal("0.01"), rounding="ROUND_HALF_UP")
    hist = {r.day_range: r.upgrades for r in subscriptions.upgrade_histogram(subs, pairs="all").collect()}
    assert hist == {"-30-0": 3, "0-30": 2, "60-90": 1, None: 1}
    with pytest.raises(ValueError):
        subscriptions.days_to_upgrade(subs, pairs="some")


def test_all_pairs_equal_first_dates_where_states_do_not_repeat(spark):
    from casebook.sources import fixtures

    subs = fixtures.subscriptions(spark)
    assert subscriptions.days_to_upgrade(subs, pairs="all").collect() == subscriptions.days_to_upgrade(subs).collect()
    assert [tuple(r) for r in subscriptions.upgrade_histogram(subs, pairs="all").collect()] == [
        tuple(r) for r in subscriptions.upgrade_histogram(subs).collect()]
