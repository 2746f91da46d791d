"""Loyalty jobs J01-J12 over (sales, menu, members).

Inputs: ``sales(customer_id, order_date, product_id)``,
``menu(product_id, product_name, price)``, ``members(customer_id, join_date)``.
Every job is a plain function of DataFrames; ``casebook.plans.catalog`` feeds
it the generated-table views and the tests feed it the case-study fixtures.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.operators import flag_since, pick_ranked, pick_spread, rank_by_histogram, top_with_ties


def _sold(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Fact to dimension on product_id (Catalyst prunes unused columns)."""
    return sales.join(menu, "product_id")


def spend_per_customer(sales, menu):
    """Total spend per customer."""
    return _sold(sales, menu).groupBy("customer_id").agg(F.sum("price").alias("amount_spent"))


def visit_days(sales):
    """Distinct order dates per customer."""
    return sales.groupBy("customer_id").agg(F.countDistinct("order_date").alias("days_visited"))


def _picked(rows: DataFrame, ascending: bool, spread: bool) -> DataFrame:
    """Each customer's rows of the first (or last) date; ``spread`` for customers with very many rows on it."""
    if spread:
        found = pick_spread(rows, ["customer_id"], "order_date", ascending)
    else:
        found = pick_ranked(rows, ["customer_id"], [("order_date", ascending)], n=1)
    return found.select("customer_id", "product_name")


def first_item(sales, menu, spread=False):
    """Items bought on each customer's first date (ties and duplicates kept)."""
    return _picked(_sold(sales, menu), True, spread)


def top_item(sales, menu):
    """The most bought item and its count; ties broken by name (top-1 is the feature)."""
    counts = _sold(sales, menu).groupBy("product_name").agg(F.count(F.lit(1)).alias("times_purchased"))
    return counts.orderBy(F.desc("times_purchased"), F.asc("product_name")).limit(1)


def favourite_item(sales, menu):
    """Each customer's most bought item(s), ties kept."""
    counts = _sold(sales, menu).groupBy("customer_id", "product_name").agg(F.count(F.lit(1)).alias("num"))
    return top_with_ties(counts, "num", keys=["customer_id"]).select("customer_id", "product_name")


def _member_sales(sales, members, menu):
    """Sales of members (inner join drops non-members) with product names."""
    return sales.join(members, "customer_id").join(menu, "product_id")


def first_after_join(sales, menu, members, spread=False):
    """First item(s) bought on or after the join date."""
    rows = _member_sales(sales, members, menu).filter(F.col("order_date") >= F.col("join_date"))
    return _picked(rows, True, spread)


def last_before_join(sales, menu, members, spread=False):
    """item(s) bought on the last date strictly before joining."""
    rows = _member_sales(sales, members, menu).filter(F.col("order_date") < F.col("join_date"))
    return _picked(rows, False, spread)


def pre_join_totals(sales, menu, members):
    """Item count and spend before joining, per member."""
    rows = _member_sales(sales, members, menu).filter(F.col("order_date") < F.col("join_date"))
    return rows.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_items"), F.sum("price").alias("amount")
    )


def points(sales, menu, double_item: str = "sushi"):
    """10 points per unit spent, ``double_item`` earns double."""
    pts = F.when(F.col("product_name") == double_item, F.col("price") * 20).otherwise(F.col("price") * 10)
    return _sold(sales, menu).groupBy("customer_id").agg(F.sum(pts).alias("points"))


def bonus_window_points(sales, menu, members, double_item: str = "sushi", days: int = 7,
                        cutoff: dt.date | str = "2021-01-31"):
    """Double points on ``double_item`` and on anything bought from the join
    date to join date + ``days`` (both inclusive), counting purchases up to ``cutoff``."""
    cut = F.lit(cutoff).cast("date")
    rows = _member_sales(sales, members, menu).filter(F.col("order_date") <= cut)
    in_window = F.col("order_date").between(F.col("join_date"), F.date_add(F.col("join_date"), days))
    pts = (
        F.when(F.col("product_name") == double_item, F.col("price") * 20)
        .when(in_window, F.col("price") * 20)
        .otherwise(F.col("price") * 10)
    )
    return rows.groupBy("customer_id").agg(F.sum(pts).alias("points"))


def join_all(sales, menu, members):
    """Denormalised sales with a Y/N member flag (non-members kept)."""
    rows = flag_since(_sold(sales, menu), members, "customer_id", "order_date", "join_date", out="member")
    return rows.select("customer_id", "order_date", "product_name", "price", "member")


def rank_members(sales, menu, members):
    """J11 plus the rank of each member purchase by date; NULL for non-member rows."""
    rows = join_all(sales, menu, members)
    is_member = F.col("member") == "Y"
    return rank_by_histogram(rows, ["customer_id", "member"], "order_date", "ranking", where=is_member)
