"""Registered queries: smoke, oracle agreement at sf0.001, and plan shape."""

import os
from collections import Counter
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F
from conftest import SF_SMALL

import __spark_entry__ as entry
from casebook.plans.catalog import QUERIES  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="generated tables not present")

TABLES = ["part", "orders", "lineitem", "events", "customer", "supplier", "nation", "region"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, Decimal):
        return ("n", v.normalize())
    return (type(v).__name__, v)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["customer_id", "plan_id", "plan_name", "payment_date", "price", "payment_order"]


def test_every_query_has_oracle_sql():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())
    assert len(QUERIES) == 64


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    want = Counter(tuple(_norm(r[i]) for i in idx) for r in cur.fetchall())
    assert got == want


BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cartesian_product(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(b in plan for b in BANNED), name


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = entry.queries()["weekly_signups"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,signup)]" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan


def test_first_pick_limits_before_the_shuffle(spark):
    df = entry.queries()["first_item"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    first_exchange = plan.index("Exchange hashpartitioning")
    # a partial limit below the exchange (map side) and the final one above it
    assert "WindowGroupLimit" in plan[:first_exchange]
    assert "WindowGroupLimit" in plan[first_exchange:]


def test_sql_over_registered_generated_views(spark):
    from casebook.sources.catalog import register_generated

    names = register_generated(spark, SF_SMALL)
    assert {"lineitem", "sales_v", "subs_v", "plans_v"} <= set(names)
    via_sql = spark.sql("SELECT customer_id, SUM(price) AS amount_spent FROM sales_v JOIN menu_v USING (product_id) "
                        "GROUP BY customer_id")
    via_api = entry.queries()["spend_per_customer"](spark, SF_SMALL)
    assert sorted(map(tuple, via_sql.collect())) == sorted(map(tuple, via_api.collect()))


@pytest.mark.parametrize("job", ["direct_churn", "conversion_share", "plan_snapshot", "annual_upgrades", "downgrades", "payments"])
def test_timeline_jobs_same_under_both_sequence_strategies(spark, job):
    from casebook.plans import catalog as C
    from casebook.plans import payments, subscriptions
    from casebook.sources import views as V
    from casebook.sources.tables import Tables

    t = Tables(spark, SF_SMALL)

    def run(method):
        if job == "payments":
            df = payments.payments(V.timeline_v(t), V.plans_v(spark), horizon=C.PAYMENT_HORIZON,
                                   tiebreak=("order_key",), method=method)
        else:
            kwargs = {"plan_snapshot": {"at": C.SNAPSHOT_AT}, "annual_upgrades": {"year": C.UPGRADE_YEAR}}.get(job, {})
            df = getattr(subscriptions, job)(V.subs_v(t), order=C.SUBS_ORDER, method=method, **kwargs)
        return Counter(tuple(_norm(v) for v in r) for r in df.collect())

    assert run("split") == run("window")


def test_partition_count_follows_scanned_bytes(spark):
    from casebook.operators._sizing import partitions_for, scanned_bytes

    big = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    floor = spark.sparkContext.defaultParallelism
    assert partitions_for(big) >= floor
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8KB")
    try:
        expected = -(-scanned_bytes(big) // 8192)
        assert partitions_for(big) == max(floor, expected) and expected > floor
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_sequence_results_hold_nothing_cached(spark):
    for name in ("direct_churn", "payments"):
        entry.queries()[name](spark, SF_SMALL).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_payments_expand_once_and_shuffle_no_payment(spark):
    df = entry.queries()["payments"](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Generate") == 1
    assert "Exchange hashpartitioning" not in plan[:plan.index("Generate")]


def test_monthly_trials_cover_the_year(spark):
    got = entry.queries()["monthly_trials"](spark, SF_SMALL).collect()
    assert [r.months for r in got] == list(range(1, 13))


@pytest.mark.parametrize("name", ["order_sizes", "delivery_speed"])
def test_sorts_fill_their_partitions(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = entry.queries()[name](spark, SF_SMALL)
        per = [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(per) == 8 and max(per) <= 2 * sum(per) / len(per)


def test_hot_member_is_split(spark, tmp_path):
    """One customer with most sales: both sides of the member join are plain shuffles, so AQE can split it."""
    from casebook.plans import loyalty
    from casebook.sources.sinks import freeze

    sales = spark.range(60_000).select(
        F.when(F.col("id") % 10 < 6, 1).otherwise(F.col("id") % 500).cast("long").alias("customer_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("order_date"),
        (F.col("id") % 7).alias("product_id"), F.repeat(F.lit("x"), 50).alias("note")).repartition(16)
    members = freeze(spark.range(500).groupBy(F.col("id").alias("customer_id")).agg(
        F.min(F.lit("2020-02-01").cast("date")).alias("join_date")), "members")
    sales.write.parquet(str(tmp_path / "sales"))
    sales = spark.read.parquet(str(tmp_path / "sales"))
    menu = spark.createDataFrame([(k, f"p{k}", 1) for k in range(7)], "product_id long, product_name string, price int")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.files.maxPartitionBytes": "100k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = loyalty.join_all(sales, menu, members)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan


def test_split_sequence_never_hash_partitions_by_customer(spark):
    from casebook.operators import along
    from casebook.sources import views as V
    from casebook.sources.tables import Tables

    seen = []
    import casebook.operators.sequence as sequence
    real = sequence.keep
    sequence.keep = lambda df, name="sequence": seen.append(df._jdf.queryExecution().toString()) or real(df, name)
    try:
        along(V.subs_v(Tables(spark, SF_SMALL)), ["customer_id"], ["start_date", "event_id"], lead={"n": "plan_id"})
    finally:
        sequence.keep = real
    assert len(seen) == 1 and "rangepartitioning(customer_id" in seen[0] and "hashpartitioning(customer_id" not in seen[0]
