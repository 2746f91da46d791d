"""The payment schedule implied by a plan timeline.

A customer's payments are its plan intervals in timeline order, dates ascending within each (the old plan's last
payment falls on the change date and precedes the new plan's first). So everything that depends on neighbouring
payments is found on *intervals*, and the calendar is expanded last:

1. priced plans: timeline x plans, trials dropped; the next change closes the interval, the horizon the last one;
2. paid intervals: churn dropped, one payment at least; monthly plans step 1 month, the annual plan 12,
   month ends drifting like ``generate_series``;
3. a pro interval that an annual one follows gives up its last payment;
4. the first payment of a pro or annual interval right after a basic payment is credited the basic price, and the
   running sum of the payment counts numbers the payments;
5. one row per payment up to the horizon. Until then payments are only counted (by arithmetic on the calendar).

The passes are range-partitioned over intervals, so a hot customer spans tasks; no expanded row is ever shuffled or stored.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.operators import along, calendar, date_at, dates_until, steps

BASIC, PRO, ANNUAL, CHURN, TRIAL = 1, 2, 3, 4, 0
BASIC_CREDIT = Decimal("9.90")


def payments(subs: DataFrame, plans: DataFrame, horizon="2020-12-31", tiebreak=(), method="split") -> DataFrame:
    horizon_d = F.lit(horizon).cast("date")
    priced = (
        subs.filter(F.col("plan_id") != TRIAL)
        .join(plans.select("plan_id", "plan_name", "price"), "plan_id")
        .select("customer_id", "plan_id", "plan_name", F.col("start_date").cast("date").alias("start_date"),
                "price", *tiebreak)
    )
    order = ["start_date", *tiebreak]
    key = ["customer_id"]
    with_next = along(priced, key, order, lead={"next_date": "start_date"}, method=method)
    step = F.when(F.col("plan_id").isin(BASIC, PRO), F.lit(1)).otherwise(F.lit(12))
    paid = (
        with_next.withColumn("stop", F.coalesce(F.col("next_date"), horizon_d)).withColumn("step", step)
        .filter((F.col("plan_id") != CHURN) & (F.col("start_date") <= F.col("stop")))
        .drop("next_date")
    )
    followed = along(paid, key, order, lead={"next_plan": "plan_id"}, method=method)
    gives_up = (F.col("plan_id") == PRO) & F.coalesce(F.col("next_plan") == ANNUAL, F.lit(False))
    series = calendar("start_date", F.col("step"))
    counted = followed.withColumn("n", F.get(F.transform(F.array(series), lambda c: dates_until(c, "stop")), 0) - gives_up.cast("long")).filter("n > 0").drop("next_plan")
    numbered = along(counted, key, order, lag={"prev_plan": "plan_id"}, running=("upto", "n"), method=method)
    each = numbered.withColumn("series", series).select("*", F.explode(steps("n")).alias("pos"))
    each = each.withColumn("payment_date", date_at(F.col("series"), F.col("pos")))
    credited = (F.col("pos") == 0) & F.col("plan_id").isin(PRO, ANNUAL) & F.coalesce(F.col("prev_plan") == BASIC, F.lit(False))
    price = F.when(credited, F.col("price") - F.lit(BASIC_CREDIT)).otherwise(F.col("price"))
    return each.filter(F.col("payment_date") <= horizon_d).select(
        "customer_id", "plan_id", "plan_name", "payment_date", price.cast("decimal(6,2)").alias("price"),
        (F.col("upto") - F.col("n") + F.col("pos") + 1).cast("int").alias("payment_order"),
    )
