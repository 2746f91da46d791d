"""Subscription jobs J44-J54 over a plan timeline.

Input: ``subs(customer_id, plan_id, start_date, ...)``, one row per plan
change. ``order`` lists the columns that order a customer's rows; add a
tiebreak when one customer can have two changes at the same instant.
Plan ids: 0 trial, 1 basic monthly, 2 pro monthly, 3 pro annual, 4 churn.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.functions import bucket_label, exact_round_ratio, width_bucket
from casebook.operators import (
    attach_scalars, daily_sketches, merged_count, pair_histogram, pair_totals, percent_of, round_percent, state_at, state_intervals,
    transition,
)
from casebook.operators.sketches import LG_K

TRIAL, BASIC, PRO, ANNUAL, CHURN = 0, 1, 2, 3, 4


def timeline(subs: DataFrame, order: Sequence[str] = ("start_date",), method: str = "split") -> DataFrame:
    """Next plan and next change date per customer. J48-J51 and J54 read it; ``ready`` passes them one that is there already."""
    ts, *tiebreak = order
    return state_intervals(subs, "customer_id", ts, "plan_id", tiebreak=tiebreak, method=method)


def total_customers(subs):
    """Distinct customers."""
    return subs.agg(F.countDistinct("customer_id").alias("total_customers"))


def customer_sketches(subs, lg_k=LG_K):
    """One row per plan and day: changes, and a sketch of their customers. J44 and the customers per plan are merges of it."""
    return daily_sketches(subs, "customer_id", "start_date", ["plan_id"], lg_k)


def customers_estimated(sketches, after=None, per_plan=False):
    """J44 (or customers per plan) from :func:`customer_sketches`, of the days after ``after``, within ``error_bound``."""
    days = None if after is None else F.col("day") > F.lit(after).cast("date")
    return merged_count(sketches, ["plan_id"] if per_plan else [], days)


def monthly_trials(subs):
    """Trial starts per month number (years pooled, as the source)."""
    trials = subs.filter(F.col("plan_id") == TRIAL)
    return trials.groupBy(F.month("start_date").alias("months")).agg(F.count(F.lit(1)).alias("trials")).orderBy("months")


def starts_after(subs, after="2020-01-01"):
    """Plan starts strictly after ``after``, per plan."""
    rows = subs.filter(F.col("start_date") > F.lit(after).cast("date"))
    return rows.groupBy("plan_id").agg(F.count(F.lit(1)).alias("starts")).orderBy("plan_id")


def _customer_flags(subs: DataFrame, flag) -> DataFrame:
    """Distinct customers and those with ``flag`` in one pass: per-customer
    max (partial aggregation, one shuffle of customers), then a global sum. A NULL
    customer counts as none, and no rows give 0, as COUNT(DISTINCT) does."""
    known = subs.filter(F.col("customer_id").isNotNull())
    per = known.groupBy("customer_id").agg(F.max(F.when(flag, 1).otherwise(0)).alias("_f"))
    return per.agg(F.count(F.lit(1)).alias("_total"), F.coalesce(F.sum("_f"), F.lit(0)).alias("_hit"))


def churn_percent(subs):
    """Churned customers and their share of all customers (not rounded)."""
    agg = _customer_flags(subs, F.col("plan_id") == CHURN)
    return agg.select(F.col("_hit").alias("churned_customers"), percent_of("_hit", "_total").alias("churned_percent"))


def direct_churn(subs, order=("start_date",), method="split", ready=None):
    """Customers whose trial is followed at once by churn, and their share."""
    nxt = timeline(subs, order, method) if ready is None else ready
    agg = _customer_flags(nxt, transition("plan_id", "next_plan", TRIAL, CHURN))
    return agg.select(F.col("_hit").alias("left_after_trial"), percent_of("_hit", "_total").alias("left_percent"))


def conversion_share(subs, order=("start_date",), method="split", ready=None):
    """Plan chosen right after the trial, against all customers of that plan.

    One grouping: each row counts for its own plan, by its customer, and each trial's row for the plan that follows it.
    """
    nxt = timeline(subs, order, method) if ready is None else ready
    nobody = F.lit(None).cast(subs.schema["customer_id"].dataType)
    own = F.struct("plan_id", F.col("customer_id").alias("_who"), F.lit(0).alias("_chosen"))
    chosen = F.struct(F.when(F.col("plan_id") == TRIAL, F.col("next_plan")).alias("plan_id"), nobody.alias("_who"), F.lit(1).alias("_chosen"))
    per_plan = nxt.select(F.explode(F.array(own, chosen)).alias("_s")).select("_s.*").filter(F.col("plan_id").isNotNull()).groupBy("plan_id").agg(
        F.sum("_chosen").alias("chosen_after_trial"), F.countDistinct("_who").alias("customers"), F.min("_chosen").alias("_only_chosen"))
    return per_plan.filter("chosen_after_trial > 0 AND _only_chosen = 0").select(
        "plan_id", "chosen_after_trial", "customers", round_percent("chosen_after_trial", "customers").alias("chosen_percent"))


def plan_snapshot(subs, at="2020-12-31", order=("start_date",), closed="neither", method="split", ready=None):
    """Customers per plan at instant ``at`` and their share of all customers.

    ``closed="neither"`` (default, as the source) drops a customer whose plan
    changes exactly at ``at``.
    """
    ts = order[0]
    nxt = timeline(subs, order, method) if ready is None else ready
    at_col = F.lit(at).cast("date")
    holding = nxt.filter(state_at(at_col, start=ts, next_="next_date", closed=closed))
    counts = holding.groupBy("plan_id").agg(F.countDistinct("customer_id").alias("customers"))
    total = subs.agg(F.countDistinct("customer_id").alias("_total"))
    out = attach_scalars(counts, total)
    return out.select("plan_id", "customers", round_percent("customers", "_total").alias("percent"))


def annual_upgrades(subs, year=2020, order=("start_date",), by_upgrade_date=False, method="split", ready=None):
    """Customers whose next plan is annual, with the *previous* plan dated
    in ``year`` (as the source); ``by_upgrade_date`` tests the upgrade's year."""
    nxt = timeline(subs, order, method) if ready is None else ready
    dated = F.col("next_date") if by_upgrade_date else F.col(order[0])
    rows = nxt.filter((F.col("next_plan") == ANNUAL) & (F.year(dated) == year))
    return rows.agg(F.countDistinct("customer_id").alias("annual_upgrades"))


def _days_to_annual(subs: DataFrame) -> DataFrame:
    """N7, first dates only: each customer's first trial date and first annual date in
    one pass, whole days between them, for (known) customers with both."""
    per = subs.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.min(F.when(F.col("plan_id") == TRIAL, F.col("start_date"))).alias("_trial"),
        F.min(F.when(F.col("plan_id") == ANNUAL, F.col("start_date"))).alias("_annual"),
    )
    both = per.filter(F.col("_trial").isNotNull() & F.col("_annual").isNotNull())
    return both.select("customer_id", F.datediff(F.to_date("_annual"), F.to_date("_trial")).alias("days"))


def _trial_annual() -> dict:
    """Every trial row of a customer with every annual row, by whole days."""
    return {"key": "customer_id", "value": F.unix_date(F.to_date("start_date")),
            "left": F.coalesce(F.col("plan_id") == TRIAL, F.lit(False)), "right": F.coalesce(F.col("plan_id") == ANNUAL, F.lit(False))}


def days_to_upgrade(subs, pairs="first"):
    """Mean whole days from trial to annual plan, rounded to 2 places.

    ``pairs="first"`` takes each customer's first trial and first annual date; ``pairs="all"`` every trial with every
    annual row of the customer, as the source's self-join does where states repeat.
    """
    if pairs == "all":
        return pair_totals(subs, **_trial_annual()).select(
            exact_round_ratio("total", "known", 2, wide=True).alias("mean_days"))
    if pairs != "first":
        raise ValueError("pairs must be 'first' or 'all'")
    days = _days_to_annual(subs)
    return days.agg(exact_round_ratio(F.sum("days"), F.count("days"), 2).alias("mean_days"))


def upgrade_histogram(subs, lo=0, hi=360, buckets=12, pairs="first", method="split"):
    """J52's day counts in equal-width buckets ('0-30', '30-60', ...): customers by their first dates, or all ``upgrades`` (pairs).

    Below ``lo`` is bucket 0 and at or past ``hi`` bucket ``buckets + 1``; ``hi - lo``
    must be a multiple of ``buckets``, so that the labels are whole days. Pairs with an unknown date have no label.
    """
    width, rest = divmod(hi - lo, buckets)
    if rest:
        raise ValueError(f"{buckets} buckets do not divide {hi - lo} days evenly")
    if pairs == "all":
        counts = pair_histogram(subs, **_trial_annual(), edges=range(lo, hi + 1, width), method=method)
        return counts.orderBy("bucket").select(bucket_label("bucket", width, lo).alias("day_range"), F.col("pairs").cast("long").alias("upgrades"))
    if pairs != "first":
        raise ValueError("pairs must be 'first' or 'all'")
    days = _days_to_annual(subs).withColumn("_b", width_bucket("days", lo, hi, buckets))
    counts = days.groupBy("_b").agg(F.count(F.lit(1)).alias("customers"))
    return counts.orderBy("_b").select(bucket_label("_b", width, lo).alias("day_range"), "customers")


def downgrades(subs, order=("start_date",), method="split", ready=None):
    """Changes from pro monthly straight to basic monthly."""
    nxt = timeline(subs, order, method) if ready is None else ready
    return nxt.filter(transition("plan_id", "next_plan", PRO, BASIC)).agg(F.count(F.lit(1)).alias("customers_downgraded"))
