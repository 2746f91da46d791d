"""Money and ratings jobs J38-J42."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions import elapsed_seconds, list_length, random_rating, stable_rating


def _item_price(premium: Column, high: int = 12, low: int = 10) -> Column:
    return F.when(premium, F.lit(high)).otherwise(F.lit(low))


def revenue(orders: DataFrame, premium: Column):
    """Fixed price per item (12 when ``premium`` holds, else 10), summed."""
    return orders.agg(F.sum(_item_price(premium)).alias("total_revenue"))


def revenue_with_extras(orders: DataFrame, premium: Column):
    """J38 plus 1 per listed extra. SUM of list lengths skips NULL lists,
    and is NULL (nulling the total) when no row has extras."""
    return orders.agg(
        (F.sum(_item_price(premium)) + F.sum(list_length("extras"))).alias("total_revenue")
    )


def ratings(deliveries: DataFrame, seed: int | None = None):
    """A 1-5 rating for every delivery (failed ones too).

    Repeatable by default (random bits of order and runner); with a
    ``seed`` it is ceil(rand(seed) * 5), as the source draws it.
    """
    rating = stable_rating("order_id", "runner_id") if seed is None else random_rating(seed)
    return deliveries.select("order_id", "runner_id", rating.alias("rating"))


def delivery_summary(orders: DataFrame, deliveries: DataFrame, rated: DataFrame):
    """Orders x deliveries x ratings with wait, duration, speed and size."""
    per_order = orders.groupBy("order_id", "customer_id", "order_time").agg(F.count("pizza_id").alias("num_items"))
    d = deliveries.select("order_id", "runner_id", "pickup_time", "duration", "distance")
    r = rated.select("order_id", "rating")
    joined = d.join(per_order, "order_id").join(r, "order_id")
    return joined.select(
        "customer_id", "order_id", "runner_id", "rating", "order_time", "pickup_time",
        elapsed_seconds("pickup_time", "order_time").alias("wait_seconds"),
        "duration",
        F.round(F.col("distance") / F.col("duration") * 60, 2).cast("decimal(38,2)").alias("average_speed"),
        "num_items",
    )


def net_revenue(orders: DataFrame, deliveries: DataFrame, premium: Column, per_km=0.30):
    """Item revenue minus ``per_km`` per km travelled.

    The two one-row totals are combined with UNION (not ALL), as the source
    does: equal totals would collapse into one before the final sum.
    """
    rate = F.lit(per_km).cast("decimal(4,2)")
    income = orders.agg(F.sum(_item_price(premium)).cast("decimal(38,3)").alias("revenue"))
    cost = deliveries.agg(F.sum(F.col("distance") * rate * -1).cast("decimal(38,3)").alias("revenue"))
    return income.union(cost).distinct().agg(F.sum("revenue").cast("decimal(38,3)").alias("total_revenue"))
