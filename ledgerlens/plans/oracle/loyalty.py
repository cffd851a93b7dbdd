"""Oracle statements of the loyalty keys, from the questions: each purchase carries its price,
name and its customer's join date, and the answers are aggregates over purchases."""

from __future__ import annotations

from .fixtures import with_tables

_PURCHASE = ("purchase", """
    SELECT s.customer_id, s.order_date, s.product_id, m.product_name, m.price, j.join_date,
           coalesce(s.order_date >= j.join_date, FALSE) AS as_member,
           10 * m.price * if(m.product_name = 'red plate', 2, 1) AS base_points
    FROM sales s JOIN menu m ON m.product_id = s.product_id
    LEFT JOIN members j ON j.customer_id = s.customer_id""")

_PARTS = ("sales", "menu", "members", _PURCHASE)


def _ask(sql: str) -> str:
    return with_tables(sql, *_PARTS)


def _nth_item(place: int) -> str:
    return _ask("SELECT product_name, count(*) AS purchase_count FROM purchase GROUP BY product_name "
                f"ORDER BY count(*) DESC, product_name LIMIT 1 OFFSET {place - 1}")


ORACLE = {
    "loyalty_total_spend": _ask(
        "SELECT customer_id, CAST(sum(price) AS DECIMAL(38,2)) AS totalspent FROM purchase GROUP BY customer_id"),
    "loyalty_visit_days": _ask(
        "SELECT customer_id, len(list_distinct(list(order_date))) AS visit_amount FROM sales GROUP BY customer_id"),
    "loyalty_first_items": _ask(
        "SELECT customer_id, unnest(arg_min(names, order_date)) AS product_name FROM ("
        "SELECT customer_id, order_date, list(DISTINCT product_name) AS names FROM purchase "
        "GROUP BY customer_id, order_date) GROUP BY customer_id"),
    "loyalty_top_item": _nth_item(1),
    "loyalty_runner_up_item": _nth_item(2),
    "loyalty_favourite_per_customer": _ask(
        "SELECT customer_id, product_name, count(*) AS product_count FROM purchase GROUP BY customer_id, product_name "
        "QUALIFY count(*) = max(count(*)) OVER (PARTITION BY customer_id)"),
    "loyalty_first_after_join": _ask(
        "SELECT customer_id AS customer, product_name FROM purchase WHERE as_member "
        "QUALIFY order_date = min(order_date) OVER (PARTITION BY customer_id)"),
    "loyalty_last_before_join": _ask(
        "SELECT customer_id AS customer, product_name AS product FROM purchase WHERE order_date < join_date "
        "QUALIFY order_date = max(order_date) OVER (PARTITION BY customer_id)"),
    "loyalty_spend_before_join": _ask(
        "SELECT customer_id, count(*) AS total_count, CAST(sum(price) AS DECIMAL(38,2)) AS total_spent "
        "FROM purchase WHERE NOT as_member AND join_date IS NOT NULL GROUP BY customer_id"),
    "loyalty_points": _ask(
        "SELECT customer_id, CAST(sum(base_points) AS DECIMAL(38,2)) AS points FROM purchase GROUP BY customer_id"),
    "loyalty_points_first_week": _ask(
        "SELECT customer_id, CAST(sum(if(as_member AND order_date < join_date + 7, 20 * price, base_points)) "
        "AS DECIMAL(38,2)) AS members_points FROM purchase "
        "WHERE join_date IS NOT NULL AND year(order_date) < 2000 GROUP BY customer_id"),
    "loyalty_joined_view": _ask(
        "SELECT customer_id, order_date, product_name, price, if(as_member, 'Y', 'N') AS member FROM purchase"),
    "loyalty_view_summary": _ask(
        "SELECT if(as_member, 'Y', 'N') AS member, count(*) AS items, CAST(sum(price) AS DECIMAL(38,2)) AS spent "
        "FROM purchase GROUP BY as_member"),
    "loyalty_member_ranking": _ask(
        "SELECT customer_id, order_date, product_name, price, if(as_member, 'Y', 'N') AS member, "
        "if(as_member, dense_rank() OVER (PARTITION BY customer_id, as_member ORDER BY order_date), NULL) "
        "AS ranking FROM purchase"),
}
