"""Tables laid out by the order key."""

import os
import re
from collections import Counter

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from casebook.plans import catalog, delivery, loyalty, pricing
from casebook.sources import layout
from casebook.sources import views as V
from casebook.sources.tables import Tables

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="generated tables not present")

JOBS = {
    "spend_per_customer": lambda t: loyalty.spend_per_customer(V.sales_v(t), V.menu_v(t)),
    "delivered_per_type": lambda t: delivery.delivered_per_type(
        delivery.clean_orders(V.raw_orders_v(t)), delivery.clean_deliveries(V.raw_deliveries_v(t))),
    "delivery_summary": lambda t: pricing.delivery_summary(
        delivery.clean_orders(V.raw_orders_v(t)), delivery.clean_deliveries(V.raw_deliveries_v(t)),
        pricing.ratings(delivery.clean_deliveries(V.raw_deliveries_v(t)))),
}


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n in names:
        spark.conf.unset(n)


def bag(df):
    return Counter(map(str, df.collect()))


def key_exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((?:\w*orderkey|order_id)#[^)]*\)", plan)


@pytest.mark.parametrize("job", sorted(JOBS))
def test_no_exchange_on_the_order_key(spark, tmp_path, no_broadcast, job):
    plain = Tables(spark, SF_SMALL)
    laid = layout.co_locate(plain, str(tmp_path / "l"), buckets=4)
    df, want = JOBS[job](laid), JOBS[job](plain)
    assert key_exchanges(df) == [] and key_exchanges(want) != []
    assert "Bucketed: true" in df._jdf.queryExecution().executedPlan().toString()
    assert bag(df) == bag(want)
    laid.remove()


def test_layout_is_recorded_and_found_again(spark, tmp_path, no_broadcast):
    home = tmp_path / "home"
    folder = str(home / layout._home(SF_SMALL))
    made = layout.co_locate(Tables(spark, SF_SMALL), folder, buckets=4)
    for name in layout.ORDER_KEY:  # as a new session: the catalog does not know the tables
        spark.sql(f"DROP TABLE {layout._table_name(folder, name)}")
    assert not isinstance(layout.tables_for(spark, SF_SMALL), layout.LaidOut)
    spark.conf.set(layout.CONF, str(home))
    try:
        t = layout.tables_for(spark, SF_SMALL)
        assert isinstance(t, layout.LaidOut) and t.by_layout("orders") and not t.by_layout("part")
        assert {x.name: (x.rows, x.buckets) for x in t.laid.values()} == {
            n: (Tables(spark, SF_SMALL)(n).count(), 4) for n in layout.ORDER_KEY}
        df = catalog.QUERIES["delivered_per_type"](spark, SF_SMALL)  # the plain name uses it when it is there
        assert key_exchanges(df) == []
    finally:
        spark.conf.unset(layout.CONF)
    assert bag(df) == bag(catalog.QUERIES["delivered_per_type"](spark, SF_SMALL))
    made.remove()
    assert not os.path.exists(folder)


def facts(spark, root, rows, hot):
    key = F.when(F.col("id") < hot, 7).otherwise(F.col("id")).cast("long")
    stamp = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    spark.range(rows).select(
        key.alias("l_orderkey"), (F.col("id") % 9).alias("l_partkey"), F.col("id").alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
        *[F.lit(1.0).alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")], F.lit("R").alias("l_returnflag"),
        F.lit("F").alias("l_linestatus"), stamp.alias("l_shipdate")).write.mode("overwrite").parquet(f"{root}/lineitem.parquet")
    spark.range(rows).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 50).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
        F.lit(1.0).alias("o_totalprice"), stamp.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority")
    ).write.mode("overwrite").parquet(f"{root}/orders.parquet")


def test_a_hot_key_keeps_the_plain_form(spark, tmp_path, monkeypatch, no_broadcast):
    monkeypatch.setattr(layout, "SMALL", 100)
    monkeypatch.setattr(layout, "SKEW", 3.0)
    facts(spark, str(tmp_path), 3000, 1500)
    plain = Tables(spark, str(tmp_path))
    laid = layout.co_locate(plain, str(tmp_path / "l"), buckets=8)
    assert laid.laid["lineitem"].buckets == 0 and laid.laid["lineitem"].fullest >= 1500 and laid.laid["orders"].buckets == 8
    assert not laid.by_layout("lineitem") and laid.by_layout("orders")
    assert bag(V.sales_v(laid)) == bag(V.sales_v(plain))


def test_buckets_follow_the_rows_in_memory_not_the_files(spark, tmp_path, monkeypatch):
    """Files that compress well hold many more bytes of rows than their own: a task sorts the rows."""
    monkeypatch.setattr(layout, "BUCKET_BYTES", 1 << 18)
    facts(spark, str(tmp_path), 60000, 0)
    t = Tables(spark, str(tmp_path))
    n = layout.bucket_number(t, layout.ORDER_KEY)
    assert 60000 * (8 + 11 * 8 + 16) / n <= 1 << 18
    assert n == 1 << (n.bit_length() - 1) and n <= 128


def test_changed_sources_are_read_again(spark, tmp_path):
    facts(spark, str(tmp_path), 200, 0)
    laid = layout.co_locate(Tables(spark, str(tmp_path)), str(tmp_path / "l"), buckets=2)
    assert laid.by_layout("lineitem") and laid("lineitem").count() == 200
    facts(spark, str(tmp_path), 300, 0)
    spark.catalog.clearCache()
    again = layout.open_layout(spark, str(tmp_path / "l"))
    assert not again.by_layout("lineitem") and again("lineitem").count() == 300


def test_empty_tables(spark, tmp_path):
    facts(spark, str(tmp_path), 0, 0)
    laid = layout.co_locate(Tables(spark, str(tmp_path)), str(tmp_path / "l"), buckets=2)
    assert V.sales_v(laid).count() == 0


def test_session_layout_is_written_once(spark, monkeypatch):
    made = []
    real = layout.co_locate
    monkeypatch.setattr(layout, "co_locate", lambda *a, **k: made.append(1) or real(*a, **k))
    layout._SESSION.clear()
    first, second = (layout.session_layout(spark, SF_SMALL) for _ in range(2))
    assert len(made) == 1 and first.folder == second.folder and second.by_layout("lineitem")
