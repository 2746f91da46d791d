"""Operators for large or uneven tables: counter-based random numbers (M5), merged ingredient lists (J36), distinct counts from sketches
(G4, G5), first picks with any number of ties (W1, W2)."""

import hashlib
import os
import random
from collections import Counter

import duckdb
import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from casebook.functions import counted_random, random_fraction, random_level, stable_rating
from casebook.operators import daily_sketches, error_bound, merged_count, pick_ranked, pick_spread, ranking
from casebook.plans import ingredients, subscriptions


# --- random numbers (M5) -------------------------------------------------------------------------------------------------

def bits(seed, *keys):
    return int(hashlib.md5(":".join([str(seed), *("~" if k is None else str(k) for k in keys)]).encode()).hexdigest()[:13], 16)


def test_random_numbers_are_those_of_their_keys(spark):
    pairs = [(k, k % 7 if k % 5 else None) for k in range(-50, 400)]
    df = spark.createDataFrame(pairs, "a long, b int")
    want = sorted((bits("s", a, b), bits("s", a, b) / 2**52, (bits("s", a, b) * 6 >> 52) + 1) for a, b in pairs)
    for n in (1, 7):
        cols = [counted_random("s", "a", "b"), random_fraction("s", "a", "b"), random_level(6, "s", "a", "b")]
        assert sorted(tuple(r) for r in df.repartition(n).select(*cols).collect()) == want
    sql = duckdb.sql("SELECT ((('0x' || substr(md5('rating:' || a || ':' || 3), 1, 13))::BIGINT * 5) >> 52) + 1 FROM range(1000) t(a)").fetchall()
    got = spark.range(1000).select("id", stable_rating("id", F.lit(3)).alias("r")).orderBy("id").collect()
    assert [r.r for r in got] == [r[0] for r in sql]


def test_random_numbers_are_even_and_independent(spark):
    """Chi-square at 1 in 10,000: levels of 100,000 keys (4 degrees of freedom), and pairs of neighbours (24)."""
    n = 100_000
    df = spark.range(n).select("id", random_level(5, 1, "id").alias("r"), random_level(5, 1, F.col("id") + 1).alias("next"))
    single = {r.r: r["count"] for r in df.groupBy("r").count().collect()}
    assert set(single) == {1, 2, 3, 4, 5} and sum((c - n / 5) ** 2 / (n / 5) for c in single.values()) < 23.5
    pairs = [r["count"] for r in df.groupBy("r", "next").count().collect()]
    assert len(pairs) == 25 and sum((c - n / 25) ** 2 / (n / 25) for c in pairs) < 59
    other = df.filter(F.col("r") == random_level(5, 2, "id")).count()
    assert abs(other - n / 5) < 4 * (n * 0.16) ** 0.5


# --- merged lists (J36) --------------------------------------------------------------------------------------------------

def test_ingredient_lists_against_brute_force(spark):
    rng = random.Random(3)
    names = {k: f"n{rng.randrange(10**6)}" for k in range(1, 30)}
    some = lambda n, top: ", ".join(str(rng.randrange(1, top)) for _ in range(n)) if n else None
    recipes = [(k, some(rng.randrange(0, 9), 32)) for k in range(20)]  # 30, 31: ids without a name
    orders = [(i, rng.randrange(0, 24), some(rng.randrange(0, 4), 32), some(rng.choice([0, 0, 1, 3, 60]), 30)) for i in range(400)]
    products = [(k, f"p{k}") for k in range(2, 24)]
    df = spark.createDataFrame(orders, "order_id int, pizza_id int, exclusions string, extras string")
    got = rows(ingredients.ingredient_list(
        df, spark.createDataFrame(recipes, "pizza_id int, toppings string"),
        spark.createDataFrame(list(names.items()), "topping_id int, topping_name string"),
        spark.createDataFrame(products, "pizza_id int, pizza_name string")))
    ids = lambda t: [int(x) for x in t.split(", ")] if t else []
    want = []
    for order, pizza, out, extra in orders:
        left = [x for x in ids(dict(recipes).get(pizza)) if x not in ids(out)] + ids(extra)
        counts = Counter(x for x in left if x in names)
        text = ", ".join(f"{n}x{names[x]}" if n > 1 else names[x] for x, n in sorted(counts.items(), key=lambda c: names[c[0]]))
        want.append((order, pizza, None if pizza not in dict(products) else f"{dict(products)[pizza]}: {text}"))
    assert got == sorted(want)


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="generated tables not present")
def test_order_items_are_not_exploded(spark):
    from casebook.plans import catalog

    df = catalog.QUERIES["ingredient_list"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    made = [k for k, line in enumerate(plan) if "Generate" in line and ("extras" in line or "exclusions" in line)]
    assert len(made) == 1  # the others are of recipes
    assert any("Aggregate [extras" in line for line in plan[made[0]:])  # the distinct extras texts


# --- sketches (G4, G5) ---------------------------------------------------------------------------------------------------

def test_merged_sketches_estimate_the_distinct_keys(spark):
    df = spark.range(200_000).select(
        (F.col("id") * 7919 % 30_000).alias("customer_id"), (F.col("id") % 3).cast("int").alias("plan_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 20).cast("int")).alias("start_date"))
    df = df.unionByName(df.limit(5).withColumn("customer_id", F.lit(None).cast("long")))
    kept = subscriptions.customer_sketches(df)
    assert kept.count() == 60
    assert {r["n"] for r in kept.groupBy().agg(F.sum("n").alias("n")).collect()} == {200_005}

    def near(estimate, exact):
        return abs(estimate - exact) <= error_bound() * exact

    assert near(subscriptions.customers_estimated(kept).first()[0], 30_000)
    for after in (None, "2024-01-10"):
        rows_ = df if after is None else df.filter(F.col("start_date") > F.lit(after).cast("date"))
        exact = {r.plan_id: r.n for r in rows_.groupBy("plan_id").agg(F.countDistinct("customer_id").alias("n")).collect()}
        got = {r.plan_id: r.customers for r in subscriptions.customers_estimated(kept, after, per_plan=True).collect()}
        assert set(got) == set(exact) and all(near(got[k], exact[k]) for k in exact)
    assert merged_count(kept.limit(0)).first()[0] == 0
    assert daily_sketches(df.limit(0), "customer_id", "start_date").count() == 0


def test_a_task_sends_one_sketch_a_group(spark):
    df = spark.range(100_000).select((F.col("id") % 50_000).alias("customer_id"), F.lit("2024-01-01").cast("date").alias("start_date"))
    plan = daily_sketches(df, "customer_id", "start_date")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("hll_sketch_agg") < plan.index("Exchange") < plan.index("partial_hll_sketch_agg")


# --- first picks with ties (W1, W2) --------------------------------------------------------------------------------------

@pytest.mark.parametrize("limit,keys", [(1_000_000, 100_000), (3, 100_000), (3, 2)])
@pytest.mark.parametrize("ascending", [True, False])
def test_spread_picks_are_the_ranked_ones(spark, monkeypatch, limit, keys, ascending):
    monkeypatch.setattr(ranking, "SPREAD_ROWS", limit)
    monkeypatch.setattr(ranking, "SPREAD_KEYS", keys)
    rng = random.Random(2)
    data = [(rng.choice([None, 1, 1, 1, 2, 3, 4, 5]), rng.choice([None, 1, 1, 2, 3, 9]), rng.choice("ab")) for _ in range(200)] + [(6, 4, "z")]
    df = spark.createDataFrame(data, "k int, d int, v string")
    want = rows(pick_ranked(df, ["k"], [("d", ascending)]))
    assert rows(pick_spread(df, ["k"], "d", ascending)) == want
    assert rows(pick_spread(df.withColumn("k2", F.lit(1)), ["k", "k2"], "d", ascending).drop("k2")) == want
    assert pick_spread(df.limit(0), ["k"], "d").count() == 0


def test_a_hot_key_with_ties_spans_tasks(spark, monkeypatch, tmp_path):
    """A customer with a third of all rows, all on its first day: its rows are picked where they stand, in every input task."""
    monkeypatch.setattr(ranking, "SPREAD_ROWS", 1000)
    spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.lit(1).alias("d"), "id").repartition(
        8).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    got = pick_spread(df, ["k"], "d")
    assert got.count() == 30_000
    per = got.where("k = 7").groupBy(F.spark_partition_id()).count().collect()
    assert len(per) >= 8 and max(r["count"] for r in per) < 2 * 10_000 / 8
