"""Delivery jobs: cleaning (J13, J14), order metrics (J15-J25) and runner
performance (J26-J31).

Inputs: ``customer_orders(order_id, customer_id, pizza_id, exclusions, extras,
order_time)`` and ``runner_orders(order_id, runner_id, pickup_time, distance,
duration, cancellation)`` as delivered (dirty text), cleaned once by J13/J14.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.functions import elapsed_minutes, exact_round_ratio, null_sentinels, strip_units, week_of_month, weekday_name
from casebook.functions.text import CANCELLATION_SENTINELS, EXCLUSION_SENTINELS, EXTRA_SENTINELS, MISSING_SENTINELS


def clean_orders(customer_orders: DataFrame) -> DataFrame:
    """Sentinel texts in the two list columns become NULL."""
    return customer_orders.select(
        "order_id", "customer_id", "pizza_id",
        null_sentinels("exclusions", EXCLUSION_SENTINELS).alias("exclusions"),
        null_sentinels("extras", EXTRA_SENTINELS).alias("extras"),
        "order_time",
    )


def clean_deliveries(runner_orders: DataFrame) -> DataFrame:
    """Sentinels to NULL, units stripped, typed columns."""
    return runner_orders.select(
        "order_id", "runner_id",
        null_sentinels("pickup_time", MISSING_SENTINELS).cast("timestamp_ntz").alias("pickup_time"),
        strip_units("distance").alias("distance"),
        strip_units("duration").alias("duration"),
        null_sentinels("cancellation", CANCELLATION_SENTINELS).alias("cancellation"),
    )


def _delivered(orders: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Order items of successful deliveries (fan-out of items kept)."""
    d = deliveries.filter(F.col("cancellation").isNull()).select("order_id")
    return orders.join(d, "order_id")


def item_count(orders):
    """Number of items ordered."""
    return orders.agg(F.count(F.lit(1)).alias("items_ordered"))


def order_count(orders):
    """Number of distinct orders."""
    return orders.agg(F.countDistinct("order_id").alias("unique_orders"))


def success_per_runner(deliveries):
    """Successful deliveries per runner."""
    ok = deliveries.filter(F.col("cancellation").isNull())
    return ok.groupBy("runner_id").agg(F.count(F.lit(1)).alias("successful_orders")).orderBy("runner_id")


def delivered_per_type(orders, deliveries):
    """Delivered items per item type."""
    return _delivered(orders, deliveries).groupBy("pizza_id").agg(F.count(F.lit(1)).alias("delivered"))


def type_pivot(rows: DataFrame, key: str, type_col: str, values: Sequence[str], other: str | None = None) -> DataFrame:
    """J19 (G8): one count column per listed type value, by conditional sums; ``other`` names one for all else."""
    cols = [F.sum(F.when(F.col(type_col) == v, F.lit(1)).otherwise(F.lit(0))).alias(v) for v in values]
    if other:
        listed = F.coalesce(F.col(type_col).isin(*values), F.lit(False))
        cols.append(F.sum(F.when(listed, F.lit(0)).otherwise(F.lit(1))).alias(other))
    return rows.groupBy(key).agg(*cols).orderBy(key)


def order_sizes(orders):
    """Items per order, largest first. The order key makes the sort even: few sizes occur, most of them in many orders."""
    sizes = orders.groupBy("order_id").agg(F.count(F.lit(1)).alias("items_in_order"))
    return sizes.orderBy(F.desc("items_in_order"), "order_id")


def changed_vs_plain(orders, deliveries):
    """Delivered items with at least one change / with none, per customer."""
    changed = F.col("exclusions").isNotNull() | F.col("extras").isNotNull()
    plain = F.col("exclusions").isNull() & F.col("extras").isNull()
    return _delivered(orders, deliveries).groupBy("customer_id").agg(
        F.sum(F.when(changed, 1).otherwise(0)).alias("changed_items"),
        F.sum(F.when(plain, 1).otherwise(0)).alias("unchanged_items"),
    )


def both_changes(orders, deliveries):
    """Delivered items with both exclusions and extras."""
    both = F.col("extras").isNotNull() & F.col("exclusions").isNotNull()
    return _delivered(orders, deliveries).filter(both).agg(F.count(F.lit(1)).alias("items_with_both"))


def hourly_volume(items: DataFrame, ts_col: str = "order_time"):
    """Items per hour of day."""
    return items.groupBy(F.hour(ts_col).alias("hour")).agg(F.count(F.lit(1)).alias("orders_per_hour")).orderBy("hour")


def weekday_volume(items: DataFrame, ts_col: str = "order_time", pad: bool = False):
    """Items per weekday name (sorted by name, as the source)."""
    day = weekday_name(ts_col, pad=pad).alias("day")
    return items.groupBy(day).agg(F.count(F.lit(1)).alias("orders_per_day")).orderBy("day")


def weekly_signups(runners: DataFrame, date_col: str = "registration_date"):
    """Sign-ups per week of the month ('1' = days 1-7)."""
    week = week_of_month(date_col).alias("week")
    return runners.groupBy(week).agg(F.count(F.lit(1)).alias("signups")).orderBy("week")


def _timed(orders, deliveries):
    joined = orders.join(deliveries.drop("cancellation"), "order_id")
    return joined.withColumn("_minutes", elapsed_minutes("pickup_time", "order_time"))


def pickup_minutes(orders, deliveries):
    """Mean minutes from order to pickup per runner, over joined items."""
    return _timed(orders, deliveries).groupBy("runner_id").agg(F.avg("_minutes").alias("average_minutes")).orderBy("runner_id")


def prep_by_order(orders, deliveries):
    """Items and mean preparation minutes per order."""
    return _timed(orders, deliveries).groupBy("order_id").agg(
        F.count("pizza_id").alias("items"), F.avg("_minutes").alias("prep_minutes")
    ).orderBy("order_id")


def mean_distance(orders, deliveries):
    """Mean distance per customer over joined items, rounded to 2 places."""
    joined = orders.join(deliveries.select("order_id", "distance"), "order_id")
    cents = F.sum((F.col("distance") * 100).cast("long"))
    return joined.groupBy("customer_id").agg(
        exact_round_ratio(cents, F.count("distance") * 100, 2).alias("average_distance")
    ).orderBy("customer_id")


def duration_range(deliveries):
    """Longest minus shortest delivery duration."""
    return deliveries.agg((F.max("duration") - F.min("duration")).alias("duration_range"))


def delivery_speed(deliveries):
    """Mean km/h per runner and order (successful deliveries)."""
    ok = deliveries.filter(F.col("cancellation").isNull())
    speed = F.col("distance") / F.col("duration") * 60
    return ok.groupBy("runner_id", "order_id").agg(
        F.round(F.avg(speed), 2).cast("decimal(38,2)").alias("average_speed")
    ).orderBy("runner_id", "order_id")


def success_percent(deliveries):
    """Orders, successes and success percentage per runner."""
    success = F.sum(F.when(F.col("cancellation").isNotNull(), 0).otherwise(1))
    return deliveries.groupBy("runner_id").agg(
        F.count("order_id").alias("total_orders"),
        success.alias("success_orders"),
        (success.cast("double") / F.count("order_id") * 100).alias("success_percent"),
    ).orderBy("runner_id")
