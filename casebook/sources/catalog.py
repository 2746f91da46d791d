"""SQL access: register tables and views as temporary views.

``register_generated`` exposes the generated tables under their own names
and the job-shaped views (``sales_v``, ``raw_orders_v``, ...). ``register_fixtures``
exposes the case-study tables under their original names (``sales``, ``menu``,
``customer_orders``, ...), so SQL written against them runs unchanged through
``spark.sql``. Registration is lazy: nothing is read until a query runs.
``createOrReplaceTempView`` replaces a previous definition (DROP + CREATE).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from casebook.sources import fixtures, views
from casebook.sources.schemas import GENERATED
from casebook.sources.tables import Tables

VIEW_BUILDERS = {
    "sales_v": views.sales_v,
    "menu_v": views.menu_v,
    "members_v": views.members_v,
    "raw_orders_v": views.raw_orders_v,
    "raw_deliveries_v": views.raw_deliveries_v,
    "pizza_names_v": views.pizza_names_v,
    "toppings_v": views.toppings_v,
    "recipe_v": views.recipe_v,
    "subs_v": views.subs_v,
    "timeline_v": views.timeline_v,
}

FIXTURE_TABLES = {
    "sales": fixtures.sales,
    "menu": fixtures.menu,
    "members": fixtures.members,
    "runners": fixtures.runners,
    "customer_orders": fixtures.customer_orders,
    "runner_orders": fixtures.runner_orders,
    "pizza_names": fixtures.pizza_names,
    "pizza_recipes": fixtures.pizza_recipes,
    "pizza_toppings": fixtures.pizza_toppings,
    "plans": fixtures.plans,
    "subscriptions": fixtures.subscriptions,
}


def register_generated(spark: SparkSession, sf_dir: str) -> list[str]:
    t = Tables(spark, sf_dir)
    names = []
    for name in GENERATED:
        t(name).createOrReplaceTempView(name)
        names.append(name)
    for name, build in VIEW_BUILDERS.items():
        build(t).createOrReplaceTempView(name)
        names.append(name)
    views.plans_v(spark).createOrReplaceTempView("plans_v")
    return names + ["plans_v"]


def register_fixtures(spark: SparkSession) -> list[str]:
    for name, build in FIXTURE_TABLES.items():
        build(spark).createOrReplaceTempView(name)
    return list(FIXTURE_TABLES)
