"""Oracle statements of the subscription keys, from the questions.

A customer's history is a list of changes in order; billing dates are generated from month
offsets: the day of the k-th date is the smallest day that any month on the way allows.
"""

from __future__ import annotations

from .fixtures import sql_ratio, with_tables

_BASE = ("subscriptions", "plans")

_HISTORY = ("history", """
    SELECT customer_id, list(plan_id ORDER BY start_date, plan_id) AS plan_ids,
           min(start_date) FILTER (plan_id = 0) AS trial,
           min(start_date) FILTER (plan_id = 2 AND start_date < DATE '2021-01-01') AS first_pro,
           arg_min(plan_id, {'d': start_date, 'p': plan_id}) FILTER (plan_id <> 0) AS first_paid,
           arg_min(plan_id, {'d': -epoch(start_date), 'p': plan_id})
             FILTER (start_date < DATE '2021-01-01') AS at_year_end
    FROM subscriptions GROUP BY customer_id""")

_UPGRADE = ("upgrade", """
    SELECT s.customer_id, s.start_date - h.trial AS days
    FROM subscriptions s JOIN history h USING (customer_id) WHERE s.plan_id = 3 AND h.trial IS NOT NULL""")

_TERM = ("term", """
    SELECT customer_id, plan_id, plan_name, price, start_date,
           lead(start_date) OVER (PARTITION BY customer_id ORDER BY start_date, plan_id) AS following
    FROM subscriptions JOIN plans USING (plan_id)
    WHERE plan_id > 0 AND year(start_date) < 2021""")

_MONTHS = ("months", """
    SELECT *, unnest(range(CAST(if(plan_id IN (1, 2),
             date_diff('month', start_date, coalesce(following, DATE '2021-01-01')), 0) AS BIGINT) + 1)) AS k
    FROM term WHERE plan_id <> 4""")

_BILL = ("bill", """
    SELECT customer_id, plan_id, plan_name, price, pay_date,
           rank() OVER (PARTITION BY customer_id ORDER BY pay_date) AS payment_order,
           lag(plan_id) OVER w AS last_plan, lag(price) OVER w AS last_price
    FROM (SELECT *, CAST(date_trunc('month', start_date) + to_months(CAST(k AS INTEGER))
                   + to_days(CAST(list_min(list_transform(range(k + 1),
                       lambda j: least(day(start_date), day(last_day(start_date + to_months(CAST(j AS INTEGER)))))))
                     AS INTEGER) - 1) AS DATE) AS pay_date
          FROM months)
    WHERE (k = 0 OR pay_date <= coalesce(following, DATE '2021-01-01'))
      AND pay_date IS DISTINCT FROM following
    WINDOW w AS (PARTITION BY customer_id ORDER BY pay_date, plan_id)""")

_PAYMENT = ("payment", """
    SELECT customer_id, plan_id, plan_name, pay_date AS start_date, payment_order,
           CAST(price - if(last_plan = 1 AND plan_id IN (2, 3), last_price, 0) AS DECIMAL(6,2)) AS amount_paid
    FROM bill""")

_PAY_PARTS = (*_BASE, _TERM, _MONTHS, _BILL, _PAYMENT)


def _plan_share(column: str, count: str, percent: str) -> str:
    return with_tables(
        f"SELECT plan_name, {count}, {sql_ratio(count, 'customers', 1, 100)} AS {percent} FROM ("
        f"SELECT plan_name, count(*) AS {count}, CAST(sum(count(*)) OVER () AS BIGINT) AS customers "
        f"FROM history JOIN plans ON plan_id = {column} GROUP BY plan_name)", *_BASE, _HISTORY)


ORACLE = {
    "subs_journey": with_tables(
        "SELECT customer_id, plan_name, start_date, price FROM plans JOIN subscriptions USING (plan_id)", *_BASE),
    "subs_customers": with_tables("SELECT count(*) AS unique_customers FROM history", *_BASE, _HISTORY),
    "subs_trials_by_month": with_tables(
        "SELECT make_date(year(start_date), month(start_date), 1) AS histogram, count(*) AS trial_starts "
        "FROM subscriptions WHERE plan_id = 0 GROUP BY year(start_date), month(start_date)", *_BASE),
    "subs_events_after": with_tables(
        "SELECT plan_name, count(*) AS events_after_2020 FROM subscriptions JOIN plans USING (plan_id) "
        "WHERE year(start_date) > 2020 GROUP BY plan_name", *_BASE),
    "subs_churn_rate": with_tables(
        "SELECT count(*) FILTER (plan_id = 4) AS churned_count, "
        + sql_ratio("count(*) FILTER (plan_id = 4)", "count(DISTINCT customer_id)", 1, 100)
        + " AS churned_percentage FROM subscriptions", *_BASE),
    "subs_immediate_churn": with_tables(
        "SELECT n AS immediate_churn, " + sql_ratio("n", "customers", 0, 100)
        + " AS immediate_churn_percentage FROM (SELECT CAST(sum(len(list_filter(list_zip(plan_ids, plan_ids[2:]), "
        "lambda p: p[1] = 0 AND p[2] = 4))) AS BIGINT) AS n, count(*) AS customers FROM history)",
        *_BASE, _HISTORY),
    "subs_first_paid_plan": _plan_share("first_paid", "plans_after_trial", "percent_plans_after_trial"),
    "subs_snapshot": _plan_share("at_year_end", "current_plan_count", "current_plan_percent"),
    "subs_annual_upgrades": with_tables(
        "SELECT count(*) FILTER (plan_id = 3 AND year(start_date) = 2020) AS annual_upgrade_2020 "
        "FROM subscriptions", *_BASE),
    "subs_days_to_annual": with_tables(
        f"SELECT {sql_ratio('sum(days)', 'count(*)', 2)} AS avg_days_to_annual FROM upgrade",
        *_BASE, _HISTORY, _UPGRADE),
    "subs_days_to_annual_bins": with_tables(
        "SELECT (30 * b + 1) || '-' || (30 * b + 30) AS period_range, count(*) AS annual_gain "
        "FROM (SELECT days // 30 AS b FROM upgrade) GROUP BY b", *_BASE, _HISTORY, _UPGRADE),
    "subs_downgrades": with_tables(
        "SELECT s.customer_id, s.start_date AS basic_start, h.first_pro AS pro_start "
        "FROM history h JOIN subscriptions s USING (customer_id) "
        "WHERE s.plan_id = 1 AND year(s.start_date) < 2021 AND s.start_date > h.first_pro",
        *_BASE, _HISTORY),
    "subs_payments": with_tables(
        "SELECT customer_id, plan_id, plan_name, start_date, amount_paid, payment_order FROM payment", *_PAY_PARTS),
    "subs_revenue_growth": with_tables(
        "SELECT monthname(make_date(2020, CAST(m AS INTEGER), 1)) AS month, "
        "CAST(cents / 100 AS DECIMAL(38,2)) AS month_payments, coalesce("
        + sql_ratio("cents - before", "before", 1, 100) + ", CAST(0 AS DECIMAL(18,1))) AS monthly_growth_percent "
        "FROM (SELECT m, cents, lag(cents) OVER (ORDER BY m) AS before FROM (SELECT month(start_date) AS m, "
        "CAST(sum(amount_paid) * 100 AS BIGINT) AS cents FROM payment GROUP BY m))", *_PAY_PARTS),
}
