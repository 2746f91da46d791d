"""Small literal fixture tables (S2: load multi-row literals with a declared type).

These are the three case-study data sets the job catalogue was written
against. They exist for golden tests: each job in ``casebook.plans`` runs on
these frames in ``tests/`` and is compared with the published answers. The
registered queries never read them; they read the generated tables through
``casebook.sources.views``.

Text literals are coerced to the declared column type on load, exactly as a
typed INSERT does ('1' into an INTEGER column).
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from casebook.sources import schemas

# ---------------------------------------------------------------------------
# The published case-study rows, in their original order.
# ---------------------------------------------------------------------------

SALES_ROWS = [
    ("A", "2021-01-01", "1"), ("A", "2021-01-01", "2"), ("A", "2021-01-07", "2"),
    ("A", "2021-01-10", "3"), ("A", "2021-01-11", "3"), ("A", "2021-01-11", "3"),
    ("B", "2021-01-01", "2"), ("B", "2021-01-02", "2"), ("B", "2021-01-04", "1"),
    ("B", "2021-01-11", "1"), ("B", "2021-01-16", "3"), ("B", "2021-02-01", "3"),
    ("C", "2021-01-01", "3"), ("C", "2021-01-01", "3"), ("C", "2021-01-07", "3"),
]

MENU_ROWS = [("1", "sushi", "10"), ("2", "curry", "15"), ("3", "ramen", "12")]

MEMBERS_ROWS = [("A", "2021-01-07"), ("B", "2021-01-09")]

RUNNERS_ROWS = [(1, "2021-01-01"), (2, "2021-01-03"), (3, "2021-01-08"), (4, "2021-01-15")]

CUSTOMER_ORDERS_ROWS = [
    ("1", "101", "1", "", "", "2021-01-01 18:05:02"),
    ("2", "101", "1", "", "", "2021-01-01 19:00:52"),
    ("3", "102", "1", "", "", "2021-01-02 23:51:23"),
    ("3", "102", "2", "", None, "2021-01-02 23:51:23"),
    ("4", "103", "1", "4", "", "2021-01-04 13:23:46"),
    ("4", "103", "1", "4", "", "2021-01-04 13:23:46"),
    ("4", "103", "2", "4", "", "2021-01-04 13:23:46"),
    ("5", "104", "1", "null", "1", "2021-01-08 21:00:29"),
    ("6", "101", "2", "null", "null", "2021-01-08 21:03:13"),
    ("7", "105", "2", "null", "1", "2021-01-08 21:20:29"),
    ("8", "102", "1", "null", "null", "2021-01-09 23:54:33"),
    ("9", "103", "1", "4", "1, 5", "2021-01-10 11:22:59"),
    ("10", "104", "1", "null", "null", "2021-01-11 18:34:49"),
    ("10", "104", "1", "2, 6", "1, 4", "2021-01-11 18:34:49"),
]

RUNNER_ORDERS_ROWS = [
    ("1", "1", "2021-01-01 18:15:34", "20km", "32 minutes", ""),
    ("2", "1", "2021-01-01 19:10:54", "20km", "27 minutes", ""),
    ("3", "1", "2021-01-03 00:12:37", "13.4km", "20 mins", None),
    ("4", "2", "2021-01-04 13:53:03", "23.4", "40", None),
    ("5", "3", "2021-01-08 21:10:57", "10", "15", None),
    ("6", "3", "null", "null", "null", "Restaurant Cancellation"),
    ("7", "2", "2021-01-08 21:30:45", "25km", "25mins", "null"),
    ("8", "2", "2021-01-10 00:15:02", "23.4 km", "15 minute", "null"),
    ("9", "2", "null", "null", "null", "Customer Cancellation"),
    ("10", "1", "2021-01-11 18:50:20", "10km", "10minutes", "null"),
]

PIZZA_NAMES_ROWS = [(1, "Meatlovers"), (2, "Vegetarian")]

PIZZA_RECIPES_ROWS = [(1, "1, 2, 3, 4, 5, 6, 8, 10"), (2, "4, 6, 7, 9, 11, 12")]

PIZZA_TOPPINGS_ROWS = [
    (1, "Bacon"), (2, "BBQ Sauce"), (3, "Beef"), (4, "Cheese"), (5, "Chicken"),
    (6, "Mushrooms"), (7, "Onions"), (8, "Pepperoni"), (9, "Peppers"), (10, "Salami"),
    (11, "Tomatoes"), (12, "Tomato Sauce"),
]

# The product appended by the "add a product" job.
NEW_PIZZA_NAME_ROW = (3, "Supreme")
NEW_PIZZA_RECIPE_ROW = (3, "1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12")

PLANS_ROWS = [
    ("0", "trial", "0"),
    ("1", "basic monthly", "9.90"),
    ("2", "pro monthly", "19.90"),
    ("3", "pro annual", "199"),
    ("4", "churn", None),
]

# A subset of the subscription timelines: customers 1-21 (the published
# payment excerpt) and the edge-case customers 51, 69, 118, 394, 711, 873.
SUBSCRIPTIONS_ROWS = [
    ("1", "0", "2020-08-01"), ("1", "1", "2020-08-08"),
    ("2", "0", "2020-09-20"), ("2", "3", "2020-09-27"),
    ("3", "0", "2020-01-13"), ("3", "1", "2020-01-20"),
    ("4", "0", "2020-01-17"), ("4", "1", "2020-01-24"), ("4", "4", "2020-04-21"),
    ("5", "0", "2020-08-03"), ("5", "1", "2020-08-10"),
    ("6", "0", "2020-12-23"), ("6", "1", "2020-12-30"), ("6", "4", "2021-02-26"),
    ("7", "0", "2020-02-05"), ("7", "1", "2020-02-12"), ("7", "2", "2020-05-22"),
    ("8", "0", "2020-06-11"), ("8", "1", "2020-06-18"), ("8", "2", "2020-08-03"),
    ("9", "0", "2020-12-07"), ("9", "3", "2020-12-14"),
    ("10", "0", "2020-09-19"), ("10", "2", "2020-09-26"),
    ("11", "0", "2020-11-19"), ("11", "4", "2020-11-26"),
    ("12", "0", "2020-09-22"), ("12", "1", "2020-09-29"),
    ("13", "0", "2020-12-15"), ("13", "1", "2020-12-22"), ("13", "2", "2021-03-29"),
    ("14", "0", "2020-09-22"), ("14", "1", "2020-09-29"),
    ("15", "0", "2020-03-17"), ("15", "2", "2020-03-24"), ("15", "4", "2020-04-29"),
    ("16", "0", "2020-05-31"), ("16", "1", "2020-06-07"), ("16", "3", "2020-10-21"),
    ("17", "0", "2020-07-27"), ("17", "1", "2020-08-03"), ("17", "3", "2020-12-11"),
    ("18", "0", "2020-07-06"), ("18", "2", "2020-07-13"),
    ("19", "0", "2020-06-22"), ("19", "2", "2020-06-29"), ("19", "3", "2020-08-29"),
    ("20", "0", "2020-04-08"), ("20", "1", "2020-04-15"), ("20", "3", "2020-06-05"),
    ("21", "0", "2020-02-04"), ("21", "1", "2020-02-11"), ("21", "2", "2020-06-03"),
    ("21", "4", "2020-09-27"),
    ("51", "0", "2020-01-19"), ("51", "1", "2020-01-26"), ("51", "3", "2020-03-09"),
    ("51", "4", "2021-03-09"),
    ("69", "0", "2020-03-07"), ("69", "1", "2020-03-14"), ("69", "2", "2020-04-14"),
    ("118", "0", "2020-01-24"), ("118", "1", "2020-01-31"), ("118", "4", "2020-06-30"),
    ("394", "0", "2020-08-17"), ("394", "1", "2020-08-24"), ("394", "4", "2021-01-24"),
    ("711", "0", "2020-10-02"), ("711", "1", "2020-10-09"), ("711", "2", "2020-11-16"),
    ("711", "4", "2020-12-31"),
    ("873", "0", "2020-03-24"), ("873", "2", "2020-03-31"), ("873", "3", "2020-06-30"),
]


# ---------------------------------------------------------------------------
# Typed loading
# ---------------------------------------------------------------------------

def _coerce(value, data_type):
    """Coerce one text literal to a Python value of the Spark type."""
    if value is None:
        return None
    name = data_type.simpleString()
    text = str(value)
    if name in ("int", "bigint"):
        return int(text)
    if name.startswith("decimal"):
        return Decimal(text).quantize(Decimal(1).scaleb(-data_type.scale))
    if name == "date":
        return dt.date.fromisoformat(text)
    if name in ("timestamp_ntz", "timestamp"):
        return dt.datetime.fromisoformat(text)
    if name == "double":
        return float(text)
    return text


def load_literals(spark: SparkSession, rows, schema) -> DataFrame:
    typed = [tuple(_coerce(v, f.dataType) for v, f in zip(row, schema.fields)) for row in rows]
    return spark.createDataFrame(typed, schema)


def sales(spark):
    return load_literals(spark, SALES_ROWS, schemas.SALES)


def menu(spark):
    return load_literals(spark, MENU_ROWS, schemas.MENU)


def members(spark):
    return load_literals(spark, MEMBERS_ROWS, schemas.MEMBERS)


def runners(spark):
    return load_literals(spark, RUNNERS_ROWS, schemas.RUNNERS)


def customer_orders(spark):
    return load_literals(spark, CUSTOMER_ORDERS_ROWS, schemas.CUSTOMER_ORDERS)


def runner_orders(spark):
    return load_literals(spark, RUNNER_ORDERS_ROWS, schemas.RUNNER_ORDERS)


def pizza_names(spark):
    return load_literals(spark, PIZZA_NAMES_ROWS, schemas.PIZZA_NAMES)


def pizza_recipes(spark):
    return load_literals(spark, PIZZA_RECIPES_ROWS, schemas.PIZZA_RECIPES)


def pizza_toppings(spark):
    return load_literals(spark, PIZZA_TOPPINGS_ROWS, schemas.PIZZA_TOPPINGS)


def plans(spark):
    return load_literals(spark, PLANS_ROWS, schemas.PLANS)


def subscriptions(spark):
    return load_literals(spark, SUBSCRIPTIONS_ROWS, schemas.SUBSCRIPTIONS)
