"""Views that present the generated tables in the shape the jobs expect.

Each view is a lazy DataFrame over the parquet scans; Catalyst prunes the
columns a job does not read and pushes its filters into the scan. The same
views are written as DuckDB CTEs in ``casebook.plans.oracle``.

| view | stands for | built from |
|---|---|---|
| sales_v | sales | lineitem x orders |
| menu_v | menu, pizza names | part |
| members_v | members | first urgent order per customer |
| raw_orders_v | customer_orders (dirty text lists) | lineitem x orders |
| raw_deliveries_v | runner_orders (dirty text) | orders |
| toppings_v | pizza_toppings | distinct words of part names |
| recipe_v | pizza_recipes | part names as word-id lists |
| subs_v | subscriptions | events |
| timeline_v | subscriptions for payments | orders |
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.operators.ranking import dense_index
from casebook.sources import fixtures
from casebook.sources.tables import Tables

# The event type -> plan id mapping of the subscription view
# and the order status -> plan mapping of the payment timeline.
EVENT_PLAN = {"signup": 0, "view": 1, "click": 2, "purchase": 3, "error": 4}
URGENT_PRIORITY = "1-URGENT"
PRO_PRIORITIES = ("1-URGENT", "2-HIGH")


def sales_v(t: Tables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_partkey")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("l_partkey").alias("product_id"),
    )


def menu_v(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_brand").alias("product_name"),
        F.col("p_type").alias("product_type"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
    )


def members_v(t: Tables) -> DataFrame:
    o = t.orders.filter(F.col("o_orderpriority") == URGENT_PRIORITY)
    return o.groupBy(F.col("o_custkey").alias("customer_id")).agg(F.min(F.to_date("o_orderdate")).alias("join_date"))


def raw_orders_v(t: Tables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    q = F.col("l_quantity").cast("int")
    ln = F.col("l_linenumber")
    exclusions = (
        F.when(ln % 4 == 0, F.lit(""))
        .when(ln % 4 == 1, F.lit("null"))
        .when(ln % 4 == 2, F.lit(None).cast("string"))
        .otherwise((q % 12 + 1).cast("string"))
    )
    extras = (
        F.when(q % 3 == 0, F.lit("null"))
        .when(q % 3 == 1, F.concat(ln.cast("string"), F.lit(", "), (ln + 5).cast("string")))
        .otherwise(F.lit(""))
    )
    return li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("pizza_id"),
        exclusions.alias("exclusions"),
        extras.alias("extras"),
        F.col("o_orderdate").alias("order_time"),
    )


def raw_deliveries_v(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    k = F.col("o_orderkey")
    failed = k % 10 == 0
    k30 = (k % 30 + 1).cast("string")
    k40 = (k % 40 + 10).cast("string")
    pickup = F.timestamp_add("MINUTE", (k % 90 + 5).cast("int"), F.col("o_orderdate"))
    return o.select(
        k.alias("order_id"),
        (F.col("o_custkey") % 100).alias("runner_id"),
        F.when(failed, F.lit("null")).otherwise(pickup.cast("string")).alias("pickup_time"),
        F.when(failed, F.lit("null"))
        .when(k % 3 == 0, F.concat(k30, F.lit("km")))
        .when(k % 3 == 1, F.concat(k30, F.lit(".4 km")))
        .otherwise(k30)
        .alias("distance"),
        F.when(failed, F.lit("null"))
        .when(k % 3 == 0, F.concat(k40, F.lit(" minutes")))
        .when(k % 3 == 1, F.concat(k40, F.lit("mins")))
        .otherwise(k40)
        .alias("duration"),
        F.when(k % 10 == 0, F.lit("Customer Cancellation"))
        .when(k % 10 == 1, F.lit(None).cast("string"))
        .when(k % 10 == 2, F.lit(""))
        .when(k % 10 == 3, F.lit("NaN"))
        .otherwise(F.lit("null"))
        .alias("cancellation"),
    )


def pizza_names_v(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("pizza_id"), F.col("p_brand").alias("pizza_name"))


def toppings_v(t: Tables) -> DataFrame:
    words = t.part.select(F.explode(F.split(F.col("p_name"), " ")).alias("topping_name"))
    return dense_index(words, "topping_name", "topping_id").select("topping_id", "topping_name")


def recipe_v(t: Tables, toppings: DataFrame | None = None) -> DataFrame:
    """One row per part: its name's words as a ', ' list of topping ids, in word order."""
    toppings = toppings if toppings is not None else toppings_v(t)
    words = t.part.select("p_partkey", F.posexplode(F.split(F.col("p_name"), " ")).alias("pos", "topping_name"))
    ids = words.join(toppings, "topping_name")
    ordered = F.sort_array(F.collect_list(F.struct("pos", F.col("topping_id").cast("string").alias("tid"))))
    return ids.groupBy(F.col("p_partkey").alias("pizza_id")).agg(
        F.array_join(F.transform(ordered, lambda s: s["tid"]), ", ").alias("toppings")
    )


def subs_v(t: Tables) -> DataFrame:
    """subscriptions(customer_id, plan_id, start_date) from events; ``event_id`` breaks ties."""
    e = t.events.select("event_id", "ts", "user_id", "event_type")
    plan = F.lit(None).cast("int")
    for name, pid in EVENT_PLAN.items():
        plan = F.when(F.col("event_type") == name, F.lit(pid)).otherwise(plan)
    return e.select(
        F.col("user_id").alias("customer_id"),
        plan.alias("plan_id"),
        F.col("ts").alias("start_date"),
        F.col("event_id"),
    )


def trials_v(t: Tables) -> DataFrame:
    """Trial starts: each customer's first order."""
    first = t.orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(F.min(F.to_date("o_orderdate")).alias("start_date"))
    return first.withColumn("plan_id", F.lit(0))


def timeline_v(t: Tables) -> DataFrame:
    """Plan timeline for the payment schedule: one state change per order.

    Open orders are monthly plans (pro for urgent/high priority, basic
    otherwise), finished orders annual plans, pending orders a stop.
    ``order_key`` breaks ties between orders of one customer on one date.
    """
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    plan = (
        F.when((F.col("o_orderstatus") == "O") & F.col("o_orderpriority").isin(*PRO_PRIORITIES), F.lit(2))
        .when(F.col("o_orderstatus") == "O", F.lit(1))
        .when(F.col("o_orderstatus") == "F", F.lit(3))
        .when(F.col("o_orderstatus") == "P", F.lit(4))
    )
    return o.select(
        F.col("o_custkey").alias("customer_id"),
        plan.alias("plan_id"),
        F.to_date("o_orderdate").alias("start_date"),
        F.col("o_orderkey").alias("order_key"),
    )


def plans_v(spark) -> DataFrame:
    """The five-row plan dimension (fixed values, see ``fixtures.PLANS_ROWS``)."""
    return fixtures.plans(spark)
