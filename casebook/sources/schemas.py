"""Declared table schemas (S1). No inference, no keys, everything nullable.

Type choices follow the source definitions: VARCHAR/TEXT -> string,
INTEGER -> int, DATE -> date, TIMESTAMP without zone -> timestamp_ntz,
DECIMAL(5,2) -> decimal(5,2).
"""

from pyspark.sql import types as T


def _schema(*cols):
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in cols])


S, I, D, TS = T.StringType(), T.IntegerType(), T.DateType(), T.TimestampNTZType()

SALES = _schema(("customer_id", S), ("order_date", D), ("product_id", I))
MENU = _schema(("product_id", I), ("product_name", S), ("price", I))
MEMBERS = _schema(("customer_id", S), ("join_date", D))

RUNNERS = _schema(("runner_id", I), ("registration_date", D))
CUSTOMER_ORDERS = _schema(
    ("order_id", I), ("customer_id", I), ("pizza_id", I),
    ("exclusions", S), ("extras", S), ("order_time", TS),
)
RUNNER_ORDERS = _schema(
    ("order_id", I), ("runner_id", I), ("pickup_time", S),
    ("distance", S), ("duration", S), ("cancellation", S),
)
PIZZA_NAMES = _schema(("pizza_id", I), ("pizza_name", S))
PIZZA_RECIPES = _schema(("pizza_id", I), ("toppings", S))
PIZZA_TOPPINGS = _schema(("topping_id", I), ("topping_name", S))

PLANS = _schema(("plan_id", I), ("plan_name", S), ("price", T.DecimalType(5, 2)))
SUBSCRIPTIONS = _schema(("customer_id", I), ("plan_id", I), ("start_date", D))

# Generated test tables: only the columns the views read are declared; Spark
# prunes the rest at the scan.
GENERATED = {
    "part": _schema(
        ("p_partkey", T.LongType()), ("p_name", S), ("p_brand", S), ("p_type", S),
        ("p_size", I), ("p_retailprice", T.DoubleType()),
    ),
    "orders": _schema(
        ("o_orderkey", T.LongType()), ("o_custkey", T.LongType()), ("o_orderstatus", S),
        ("o_totalprice", T.DoubleType()), ("o_orderdate", TS), ("o_orderpriority", S),
    ),
    "lineitem": _schema(
        ("l_orderkey", T.LongType()), ("l_partkey", T.LongType()), ("l_suppkey", T.LongType()),
        ("l_linenumber", I), ("l_quantity", T.DoubleType()), ("l_extendedprice", T.DoubleType()),
        ("l_discount", T.DoubleType()), ("l_tax", T.DoubleType()), ("l_returnflag", S),
        ("l_linestatus", S), ("l_shipdate", TS),
    ),
    "events": _schema(
        ("event_id", T.LongType()), ("ts", TS), ("user_id", T.LongType()),
        ("event_type", S), ("value", T.DoubleType()), ("props", S),
    ),
}
