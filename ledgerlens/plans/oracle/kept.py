"""Oracle statements of the kept tables, loads and log checks."""

from __future__ import annotations

from .fixtures import with_tables

#: Keys whose answer is that of another key.
SAME = {"kept_weekly_sales": "clean_weekly_sales", "kept_category_funnel": "category_funnel",
        "kept_clean_runs": "clean_runs"}

_DIV = "o_orderkey % 7"
_LATE = """
        SELECT o_custkey AS customer_id, o_orderkey AS order_id FROM orders o
        WHERE EXISTS (SELECT 1 FROM orders e WHERE e.o_custkey = o.o_custkey
                      AND e.o_orderkey < o.o_orderkey AND e.o_orderdate > o.o_orderdate)"""

ORACLE = {
    "kept_monthly_visitors": """
        SELECT strftime(ts, '%B') AS month, count(DISTINCT (user_id, CAST(ts AS DATE))) AS visit_count,
               count(DISTINCT user_id) AS user_count
        FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL GROUP BY month""",
    # a multiple of seven is cancelled and rated 0; six is out of range; what the first load took
    # is known to the second one
    "loaded_ratings": f"""
        SELECT broken, count(*) AS ratings, count(*) AS timed FROM (
          SELECT CASE {_DIV} WHEN 0 THEN 'rating_1_to_5, fk_order_id' WHEN 6 THEN 'rating_1_to_5' ELSE again END AS broken
          FROM orders CROSS JOIN (VALUES (''), ('pk')) AS l(again)) GROUP BY broken""",
    "orders_without_items": """
        SELECT n AS order_id FROM (SELECT unnest(range(min(o_orderkey), max(o_orderkey) + 1)) AS n FROM orders)
        WHERE n NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL)""",
    "log_late_changes": _LATE,
    "kept_late_changes": _LATE,
    "log_same_day_changes": with_tables(
        "SELECT customer_id, start_date, count(*) AS copies FROM subscriptions "
        "GROUP BY customer_id, start_date HAVING count(*) > 1", "subscriptions"),
    "loyalty_overlapping_offers": with_tables(
        "SELECT a.customer_id, a.join_date, CAST(a.join_date + 2 AS DATE) AS last_date FROM members a "
        "WHERE EXISTS (SELECT 1 FROM members b WHERE b.customer_id <> a.customer_id "
        "AND b.join_date <= a.join_date + 2 AND a.join_date <= b.join_date + 2)", "members"),
}
