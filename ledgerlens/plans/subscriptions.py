"""Subscription timelines, billing schedule and growth (the case-3 catalogue).

Shapes: ``subscriptions(customer_id, plan_id, start_date)`` (one row per plan
change) and ``plans(plan_id, plan_name, price)``. Plan codes: 0 trial,
1 basic monthly, 2 pro monthly, 3 pro annual, 4 churn.

Neighbour values inside a customer's timeline (next change, previous billed
plan, payment order) come from ``operators.sequences.sequence_columns``, whose
windows hold one customer's month at a time; the schedule expansion between
them is a narrow explode. Plans are a fixed 5-row dimension. Changes of one
customer on one day are ordered by plan id.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import int_div, ratio
from ..operators.asof import earliest_per_key, role_join, snapshot_at
from ..operators.calendar import recurring_schedule
from ..operators.ranking import growth
from ..operators.sequences import sequence_columns
from ..operators.sizing import fixed_dimension

TRIAL, BASIC, PRO, ANNUAL, CHURN = 0, 1, 2, 3, 4
# Analysis parameters: the reporting year, its end (exclusive) and the
# billing horizon (inclusive, so plans starting on the 1st bill on it).
YEAR_START = dt.date(2020, 1, 1)
YEAR_END = dt.date(2021, 1, 1)
BIN_DAYS = 30


def journey(subs, plans, customers: list[int] | None = None):
    """Plan history per customer (optionally for chosen customers)."""
    j = subs.join(fixed_dimension(plans), "plan_id")
    if customers:
        j = j.where(F.col("customer_id").isin(customers))
    return j.orderBy("customer_id", "start_date", "plan_id") \
        .select("customer_id", "plan_name", "start_date", "price")


def distinct_customers(subs):
    return subs.agg(F.countDistinct("customer_id").alias("unique_customers"))


def trials_by_month(subs):
    return (subs.where(F.col("plan_id") == TRIAL)
            .groupBy(F.trunc("start_date", "MM").alias("histogram"))
            .agg(F.count(F.lit(1)).alias("trial_starts")).orderBy("histogram"))


def events_after(subs, plans, after=YEAR_END):
    return (subs.where(F.col("start_date") >= F.lit(after)).join(fixed_dimension(plans), "plan_id")
            .groupBy("plan_name").agg(F.count(F.lit(1)).alias("events_after_2020")))


def churn_rate(subs):
    churned = F.sum(F.when(F.col("plan_id") == CHURN, 1).otherwise(0))
    return subs.agg(churned.alias("churned_count"),
                    ratio(churned, F.countDistinct("customer_id"), 1, 100)
                    .alias("churned_percentage"))


def immediate_churn(subs):
    """Churn rows whose previous change is the trial, over distinct customers."""
    flagged = sequence_columns(subs, ["customer_id"], ["start_date", "plan_id"],
                               lags={"lag_id": "plan_id"})
    n = F.sum(F.when((F.col("plan_id") == CHURN) & (F.col("lag_id") == TRIAL), 1).otherwise(0))
    return flagged.agg(n.alias("immediate_churn"),
                       ratio(n, F.countDistinct("customer_id"), 0, 100)
                       .alias("immediate_churn_percentage"))


def _share(counted: DataFrame, count_col: str, name: str, scale: int = 1) -> DataFrame:
    total = F.sum(count_col).over(Window.partitionBy())
    return counted.withColumn(name, ratio(F.col(count_col), total, scale, 100))


def first_paid_plan(subs, plans):
    firsts = earliest_per_key(subs.where(F.col("plan_id") != TRIAL), "customer_id",
                              ["start_date", "plan_id"])
    counted = (firsts.join(fixed_dimension(plans), "plan_id").groupBy("plan_name")
               .agg(F.count("plan_name").alias("plans_after_trial")))
    return _share(counted, "plans_after_trial", "percent_plans_after_trial")


def snapshot(subs, plans, before=YEAR_END):
    current = snapshot_at(subs, "customer_id", "start_date", before, [F.col("plan_id")])
    counted = (current.join(fixed_dimension(plans), "plan_id").groupBy("plan_name")
               .agg(F.count("plan_name").alias("current_plan_count")))
    return _share(counted, "current_plan_count", "current_plan_percent")


def annual_upgrades(subs, start=YEAR_START, end=YEAR_END):
    return (subs.where((F.col("start_date") >= F.lit(start)) & (F.col("start_date") < F.lit(end))
                       & (F.col("plan_id") == ANNUAL))
            .agg(F.count(F.lit(1)).alias("annual_upgrade_2020")))


def _trial_to_annual(subs):
    return role_join(subs, "customer_id", "start_date", F.col("plan_id") == TRIAL,
                     F.col("plan_id") == ANNUAL, "trial_date", "annual_date")


def days_to_annual(subs):
    days = F.datediff("annual_date", "trial_date")
    return _trial_to_annual(subs).agg(
        ratio(F.sum(days), F.count(F.lit(1)), 2).alias("avg_days_to_annual"))


def days_to_annual_bins(subs, width: int = BIN_DAYS):
    """Bins labelled ``1-30``, ``31-60``..: day counts 0-29 fall in ``1-30``."""
    hi = (int_div(F.datediff("annual_date", "trial_date"), width) + 1) * width
    binned = _trial_to_annual(subs).select("customer_id", hi.alias("histo"))
    return (binned.groupBy("histo").agg(F.count("customer_id").alias("annual_gain"))
            .orderBy("histo")
            .select(F.concat_ws("-", (F.col("histo") - (width - 1)).cast("string"),
                                F.col("histo").cast("string")).alias("period_range"),
                    "annual_gain"))


def downgrades(subs, before=YEAR_END):
    """Every change to basic that comes after the customer's first pro start, with that start:
    one row per basic change, however often the customer went back and forth."""
    early = subs.where(F.col("start_date") < F.lit(before))
    pairs = role_join(early, "customer_id", "start_date", F.col("plan_id") == PRO,
                      F.col("plan_id") == BASIC, "pro_start", "basic_start", later_only=True)
    return pairs.select("customer_id", "basic_start", "pro_start")


def payments(subs, plans, year_end=YEAR_END, horizon=YEAR_END):
    """Billing schedule for paid plans changed before ``year_end``.

    Monthly plans bill every month (each date one month after the previous)
    until the next change or the inclusive ``horizon``; annual plans bill once;
    churn caps the previous plan and is not billed; a monthly date falling on
    the next change's day is dropped; an upgrade from basic is credited with
    the basic price just paid. Payments of one day share their order (RANK)."""
    changes = (subs.where((F.col("plan_id") != TRIAL) & (F.col("start_date") < F.lit(year_end)))
               .join(fixed_dimension(plans), "plan_id"))
    base = sequence_columns(changes, ["customer_id"], ["start_date", "plan_id"],
                            leads={"next_plan_date": "start_date"})
    base = base.withColumn("bound", F.coalesce("next_plan_date", F.lit(horizon)))
    repeat = ~F.col("plan_id").isin(ANNUAL, CHURN)
    sched = (recurring_schedule(base, "start_date", "bound", repeat, "pay_date")
             .where((F.col("plan_id") != CHURN)
                    & (F.col("next_plan_date").isNull()
                       | (F.col("pay_date") != F.col("next_plan_date")))))
    sched = sequence_columns(sched, ["customer_id"], ["pay_date", "plan_id"],
                             lags={"last_plan": "plan_id", "last_price": "price"},
                             rank="payment_order")
    credit = F.col("plan_id").isin(PRO, ANNUAL) & (F.col("last_plan") == BASIC)
    amount = F.when(credit, F.col("price") - F.col("last_price")).otherwise(F.col("price"))
    return sched.select("customer_id", "plan_id", "plan_name",
                        F.col("pay_date").alias("start_date"),
                        amount.cast("decimal(6,2)").alias("amount_paid"), "payment_order")


def revenue_growth(pay: DataFrame) -> DataFrame:
    """Month-over-month growth of billed amounts, grouped by calendar month
    (years merged); the first month's growth is 0."""
    monthly = (pay.groupBy(F.date_format("start_date", "MMMM").alias("month"),
                           F.month("start_date").alias("date_order"))
               .agg(F.sum("amount_paid").cast("decimal(38,2)").alias("month_payments")))
    cents = monthly.withColumn("_cents", (F.col("month_payments") * 100).cast("bigint"))
    grown = growth(cents, "date_order", "_cents", "monthly_growth_percent", scale=1)
    return grown.select("month", "month_payments", "monthly_growth_percent")
