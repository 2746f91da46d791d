"""Registry of named queries over the generated tables.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame: a job
function applied to the views of ``casebook.sources.views``. Parameters the
case study fixed to its own calendar (cut-off dates, horizon, histogram
width) are set here for the generated data.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.operators.lists import zip_lists
from casebook.operators.sketches import error_bound
from casebook.plans import delivery, ingredients, loyalty, payments, pricing, subscriptions
from casebook.sources import fixtures
from casebook.sources import views as V
from casebook.sources.layout import session_layout, tables_for
from casebook.sources.sinks import freeze, new_folder
from casebook.sources.store import StoredTable
from casebook.sources.temp_tables import session_tables

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

# Parameters of the generated-data runs.
DOUBLE_ITEM = "Brand#1"          # the product earning double points
POINTS_CUTOFF = "1999-01-31"     # J10 cut-off date
PREMIUM_TYPE = "ECONOMY"         # product type priced 12 (others 10)
EVENTS_AFTER = "2024-01-15"      # J46 "starts after"
SNAPSHOT_AT = "2024-01-15"       # J50 snapshot instant
UPGRADE_YEAR = 2024              # J51 year of the plan before the upgrade
HIST_WIDTH, HIST_BUCKETS = 10, 3  # J53: 0-30 days in 10-day buckets
PAYMENT_HORIZON = "1998-12-31"   # J55 horizon
# The product types shown as columns by J19, and the product
# appended by J43 (name and recipe as in the case study).
PRODUCT_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
NEW_PRODUCT = (fixtures.NEW_PIZZA_NAME_ROW[1], fixtures.NEW_PIZZA_RECIPE_ROW[1])


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def _members(t):
    """The members, written once: a plain table joins by two plain shuffles, which AQE can split at a hot customer
    (an aggregate's own partitioning cannot be split)."""
    return freeze(V.members_v(t), "members")


# --- loyalty (J01-J12) -------------------------------------------------------

@register("spend_per_customer")
def _j01(spark, sf):
    t = tables_for(spark, sf)
    return loyalty.spend_per_customer(V.sales_v(t), V.menu_v(t))


@register("visit_days")
def _j02(spark, sf):
    return loyalty.visit_days(V.sales_v(tables_for(spark, sf)))


@register("first_item")
def _j03(spark, sf):
    t = tables_for(spark, sf)
    return loyalty.first_item(V.sales_v(t), V.menu_v(t))


@register("first_item_spread")
def _j03_spread(spark, sf):
    """J03 without a rank: a customer may have any number of items on the first date."""
    t = tables_for(spark, sf)
    return loyalty.first_item(V.sales_v(t), V.menu_v(t), spread=True)


@register("top_item")
def _j04(spark, sf):
    t = tables_for(spark, sf)
    return loyalty.top_item(V.sales_v(t), V.menu_v(t))


@register("favourite_item")
def _j05(spark, sf):
    t = tables_for(spark, sf)
    return loyalty.favourite_item(V.sales_v(t), V.menu_v(t))


@register("first_after_join")
def _j06(spark, sf):
    t = tables_for(spark, sf)
    return loyalty.first_after_join(V.sales_v(t), V.menu_v(t), _members(t))


@register("last_before_join")
def _j07(spark, sf):
    t = tables_for(spark, sf)
    return loyalty.last_before_join(V.sales_v(t), V.menu_v(t), _members(t))


@register("pre_join_totals")
def _j08(spark, sf):
    t = tables_for(spark, sf)
    return loyalty.pre_join_totals(V.sales_v(t), V.menu_v(t), _members(t))


@register("points")
def _j09(spark, sf):
    t = tables_for(spark, sf)
    return loyalty.points(V.sales_v(t), V.menu_v(t), double_item=DOUBLE_ITEM)


@register("bonus_window_points")
def _j10(spark, sf):
    t = tables_for(spark, sf)
    return loyalty.bonus_window_points(
        V.sales_v(t), V.menu_v(t), _members(t), double_item=DOUBLE_ITEM, cutoff=POINTS_CUTOFF
    )


@register("join_all")
def _j11(spark, sf):
    t = tables_for(spark, sf)
    return loyalty.join_all(V.sales_v(t), V.menu_v(t), _members(t))


@register("rank_members")
def _j12(spark, sf):
    t = tables_for(spark, sf)
    return loyalty.rank_members(V.sales_v(t), V.menu_v(t), _members(t))


# --- cleaning and order metrics (J13-J25) -----------------------------------

def _orders(t):
    return delivery.clean_orders(V.raw_orders_v(t))


def _deliveries(t):
    return delivery.clean_deliveries(V.raw_deliveries_v(t))


@register("clean_orders")
def _j13(spark, sf):
    return _orders(tables_for(spark, sf))


@register("clean_deliveries")
def _j14(spark, sf):
    return _deliveries(tables_for(spark, sf))


@register("item_count")
def _j15(spark, sf):
    return delivery.item_count(_orders(tables_for(spark, sf)))


@register("order_count")
def _j16(spark, sf):
    return delivery.order_count(_orders(tables_for(spark, sf)))


@register("success_per_runner")
def _j17(spark, sf):
    return delivery.success_per_runner(_deliveries(tables_for(spark, sf)))


@register("delivered_per_type")
def _j18(spark, sf):
    t = tables_for(spark, sf)
    return delivery.delivered_per_type(_orders(t), _deliveries(t))


@register("type_pivot")
def _j19(spark, sf):
    t = tables_for(spark, sf)
    rows = V.sales_v(t).join(V.menu_v(t).select("product_id", "product_type"), "product_id")
    return delivery.type_pivot(rows, "customer_id", "product_type", PRODUCT_TYPES, other="OTHER")


@register("order_sizes")
def _j20(spark, sf):
    return delivery.order_sizes(_orders(tables_for(spark, sf)))


@register("changed_vs_plain")
def _j21(spark, sf):
    t = tables_for(spark, sf)
    return delivery.changed_vs_plain(_orders(t), _deliveries(t))


@register("both_changes")
def _j22(spark, sf):
    t = tables_for(spark, sf)
    return delivery.both_changes(_orders(t), _deliveries(t))


@register("hourly_volume")
def _j23(spark, sf):
    return delivery.hourly_volume(tables_for(spark, sf).events, "ts")


@register("weekday_volume")
def _j24(spark, sf):
    return delivery.weekday_volume(_orders(tables_for(spark, sf)), "order_time")


@register("weekly_signups")
def _j25(spark, sf):
    e = tables_for(spark, sf).events.filter(F.col("event_type") == "signup")
    runners = e.select(F.col("user_id").alias("runner_id"), F.to_date("ts").alias("registration_date"))
    return delivery.weekly_signups(runners)


# --- runner performance (J26-J31) -------------------------------------------

@register("pickup_minutes")
def _j26(spark, sf):
    t = tables_for(spark, sf)
    return delivery.pickup_minutes(_orders(t), _deliveries(t))


@register("prep_by_order")
def _j27(spark, sf):
    t = tables_for(spark, sf)
    return delivery.prep_by_order(_orders(t), _deliveries(t))


@register("mean_distance")
def _j28(spark, sf):
    t = tables_for(spark, sf)
    return delivery.mean_distance(_orders(t), _deliveries(t))


@register("duration_range")
def _j29(spark, sf):
    return delivery.duration_range(_deliveries(tables_for(spark, sf)))


@register("delivery_speed")
def _j30(spark, sf):
    return delivery.delivery_speed(_deliveries(tables_for(spark, sf)))


@register("success_percent")
def _j31(spark, sf):
    return delivery.success_percent(_deliveries(tables_for(spark, sf)))


# --- on tables laid out by the order key (N2) --------------------------------

@register("spend_per_customer_colocated")
def _j01_colocated(spark, sf):
    """J01 on a layout by the order key: the fact join has no exchange."""
    t = session_layout(spark, sf)
    return loyalty.spend_per_customer(V.sales_v(t), V.menu_v(t))


@register("delivered_per_type_colocated")
def _j18_colocated(spark, sf):
    t = session_layout(spark, sf)
    return delivery.delivered_per_type(_orders(t), _deliveries(t))


@register("delivery_summary_colocated")
def _j41_colocated(spark, sf):
    t = session_layout(spark, sf)
    d = _deliveries(t)
    return pricing.delivery_summary(_orders(t), d, pricing.ratings(d))


# --- ingredients (J32-J37, J43) ---------------------------------------------

def _orders_once(t):
    """The cleaned order items, joined and written once for jobs that read them several times."""
    return freeze(_orders(t), "orders")


def _recipe_parts(t):
    toppings = V.toppings_v(t)
    return V.recipe_v(t, toppings), toppings, V.pizza_names_v(t)


@register("standard_ingredients")
def _j32(spark, sf):
    recipes, toppings, names = _recipe_parts(tables_for(spark, sf))
    return ingredients.standard_ingredients(recipes, toppings, names)


@register("top_extra")
def _j33(spark, sf):
    t = tables_for(spark, sf)
    return ingredients.top_extra(_orders(t), V.toppings_v(t))


@register("top_exclusion")
def _j34(spark, sf):
    t = tables_for(spark, sf)
    return ingredients.top_exclusion(_orders(t), V.toppings_v(t))


@register("order_item_label")
def _j35(spark, sf):
    t = tables_for(spark, sf)
    return ingredients.order_item_label(_orders_once(t), V.pizza_names_v(t), V.toppings_v(t))


@register("ingredient_list")
def _j36(spark, sf):
    t = tables_for(spark, sf)
    recipes, toppings, names = _recipe_parts(t)
    return ingredients.ingredient_list(_orders_once(t), recipes, toppings, names)


@register("list_pairs")
def _c9(spark, sf):
    """Exclusions and extras of each order item side by side."""
    rows = _orders(tables_for(spark, sf)).select("order_id", "pizza_id", "exclusions", "extras")
    return zip_lists(rows, "exclusions", "extras", "exclusion_id", "extra_id")


@register("ingredient_totals")
def _j37(spark, sf):
    t = tables_for(spark, sf)
    recipes, _, _ = _recipe_parts(t)
    return ingredients.ingredient_totals(_orders_once(t), recipes)


@register("add_product")
def _j43(spark, sf):
    recipes, toppings, names = _recipe_parts(tables_for(spark, sf))
    name, text = NEW_PRODUCT
    return ingredients.add_product(names, recipes, toppings, name, text)


@register("add_product_stored")
def _j43_stored(spark, sf):
    """J43 through the sinks: products and recipes become stored tables, the new rows are appended as a batch (twice, as a
    retried job would; once is what counts), and the recipes are replaced from themselves."""
    t = tables_for(spark, sf)
    recipes, toppings, names = _recipe_parts(t)
    name, text = NEW_PRODUCT
    with_new = StoredTable(spark, new_folder(spark, "products")), StoredTable(spark, new_folder(spark, "recipes"))
    for table, rows in zip(with_new, (names, recipes)):
        table.replace(rows)
    new_rows = ingredients.product_rows(with_new[0].read(), with_new[1].read(), name, text)
    new_rows = [freeze(rows, "new-product") for rows in new_rows]  # the next id must not see its own row
    for _ in range(2):
        for table, rows in zip(with_new, new_rows):
            table.append(rows, batch="J43")
    with_new[1].replace(with_new[1].read().where("toppings IS NOT NULL"))
    return ingredients.standard_ingredients(with_new[1].read(), toppings, with_new[0].read())


# --- money and ratings (J38-J42) --------------------------------------------

def _priced_orders(t):
    types = V.menu_v(t).select(F.col("product_id").alias("pizza_id"), "product_type")
    return _orders(t).join(types, "pizza_id")


def _premium():
    return F.col("product_type") == PREMIUM_TYPE


@register("revenue")
def _j38(spark, sf):
    return pricing.revenue(_priced_orders(tables_for(spark, sf)), _premium())


@register("revenue_with_extras")
def _j39(spark, sf):
    return pricing.revenue_with_extras(_priced_orders(tables_for(spark, sf)), _premium())


@register("ratings")
def _j40(spark, sf):
    return pricing.ratings(_deliveries(tables_for(spark, sf)))


@register("delivery_summary")
def _j41(spark, sf):
    t = tables_for(spark, sf)
    d = _deliveries(t)
    return pricing.delivery_summary(_orders(t), d, pricing.ratings(d))


@register("net_revenue")
def _j42(spark, sf):
    t = tables_for(spark, sf)
    return pricing.net_revenue(_priced_orders(t), _deliveries(t), _premium())


# --- subscriptions (J44-J54) ------------------------------------------------

SUBS_ORDER = ("start_date", "event_id")


def _on_subs(job: Callable[..., DataFrame], spark, sf, **more) -> DataFrame:
    """``job`` on the subscriptions and their timeline, which the session's jobs share: written by the first, read by the others.
    The timeline is held as long as the job's DataFrame lives."""
    t = tables_for(spark, sf)
    subs = V.subs_v(t)
    lease = session_tables(spark).lease("timeline", subs, lambda: subscriptions.timeline(subs, SUBS_ORDER), SUBS_ORDER,
                                        inputs=[t.path("events")])
    out = job(subs=subs, order=SUBS_ORDER, ready=lease.df, **more)
    weakref.finalize(out, lease.release).atexit = False
    return out


@register("total_customers")
def _j44(spark, sf):
    return subscriptions.total_customers(V.subs_v(tables_for(spark, sf)))


@register("customers_sketched")
def _g5_sketched(spark, sf):
    """Customers per plan, exact and whether the merge of daily sketches is within its error bound."""
    subs = V.subs_v(tables_for(spark, sf))
    exact = subs.groupBy("plan_id").agg(F.countDistinct("customer_id").alias("customers"))
    merged = subscriptions.customers_estimated(freeze(subscriptions.customer_sketches(subs), "sketches"), per_plan=True)
    near = F.abs(F.col("estimate") - F.col("customers")) <= error_bound() * F.col("customers")
    merged = merged.select(F.col("plan_id").alias("_plan"), F.col("customers").alias("estimate"))
    return exact.join(merged, F.col("plan_id").eqNullSafe(F.col("_plan"))).select("plan_id", "customers", near.alias("within_bound"))


@register("monthly_trials")
def _j45(spark, sf):
    return subscriptions.monthly_trials(V.trials_v(tables_for(spark, sf)))


@register("starts_after")
def _j46(spark, sf):
    return subscriptions.starts_after(V.subs_v(tables_for(spark, sf)), after=EVENTS_AFTER)


@register("churn_percent")
def _j47(spark, sf):
    return subscriptions.churn_percent(V.subs_v(tables_for(spark, sf)))


@register("direct_churn")
def _j48(spark, sf):
    return _on_subs(subscriptions.direct_churn, spark, sf)


@register("conversion_share")
def _j49(spark, sf):
    return _on_subs(subscriptions.conversion_share, spark, sf)


@register("plan_snapshot")
def _j50(spark, sf):
    return _on_subs(subscriptions.plan_snapshot, spark, sf, at=SNAPSHOT_AT)


@register("annual_upgrades")
def _j51(spark, sf):
    return _on_subs(subscriptions.annual_upgrades, spark, sf, year=UPGRADE_YEAR)


@register("days_to_upgrade")
def _j52(spark, sf):
    return subscriptions.days_to_upgrade(V.subs_v(tables_for(spark, sf)))


@register("upgrade_histogram")
def _j53(spark, sf):
    return subscriptions.upgrade_histogram(
        V.subs_v(tables_for(spark, sf)), lo=0, hi=HIST_WIDTH * HIST_BUCKETS, buckets=HIST_BUCKETS
    )


@register("days_to_upgrade_pairs")
def _j52_pairs(spark, sf):
    """J52 with the self-join's fan-out: every trial with every annual row."""
    return subscriptions.days_to_upgrade(V.subs_v(tables_for(spark, sf)), pairs="all")


@register("upgrade_histogram_pairs")
def _j53_pairs(spark, sf):
    return subscriptions.upgrade_histogram(
        V.subs_v(tables_for(spark, sf)), lo=0, hi=HIST_WIDTH * HIST_BUCKETS, buckets=HIST_BUCKETS, pairs="all"
    )


@register("downgrades")
def _j54(spark, sf):
    return _on_subs(subscriptions.downgrades, spark, sf)


# --- payment schedule (J55) -------------------------------------------------

@register("payments")
def _j55(spark, sf):
    t = tables_for(spark, sf)
    return payments.payments(V.timeline_v(t), V.plans_v(spark), horizon=PAYMENT_HORIZON, tiebreak=("order_key",))
