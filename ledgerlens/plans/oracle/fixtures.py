"""DuckDB twins of ``ledgerlens.sources.fixtures``: one CTE body per adapter.

``with_tables(query, *names)`` prefixes ``query`` with the CTEs it reads
(dependencies first), so each oracle statement is self-contained SQL over the
pre-registered base views.
"""

from __future__ import annotations

from ...sources.fixtures import (CAMPAIGNS, EVENT_CODES, EVENT_TYPES, ITEM_TYPES, PAGES, PLANS,
                                 PRIORITY_PLANS, RECIPES, SEGMENT_CODES, CUSTOMER_TYPES,
                                 TOPPINGS)


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def _values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(cols)})"


def _case(expr: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN {expr} = {_lit(k)} THEN {_lit(v)}" for k, v in mapping.items())
    return f"CASE {whens} ELSE {default} END"


def _list_text(sel: str, x: str) -> str:
    a = f"CAST({x} % 12 + 1 AS VARCHAR)"
    b = f"CAST(({x} // 12) % 12 + 1 AS VARCHAR)"
    return (f"CASE {sel} WHEN 0 THEN 'null' WHEN 1 THEN '' WHEN 2 THEN NULL "
            f"WHEN 3 THEN {a} WHEN 4 THEN {a} || ', ' || {b} ELSE ' NaN ' END")


_ORDER_TIME = "o_orderdate + ((o_orderkey * 37) % 86400) * INTERVAL 1 SECOND"

ADAPTERS: dict[str, tuple[tuple[str, ...], str]] = {
    "item_types": ((), "SELECT CAST(item_type_id AS INTEGER) AS item_type_id, item_name FROM ("
                   + _values(ITEM_TYPES, ["item_type_id", "item_name"]) + ")"),
    "recipes": ((), "SELECT CAST(item_type_id AS INTEGER) AS item_type_id, toppings FROM ("
                + _values(RECIPES, ["item_type_id", "toppings"]) + ")"),
    "toppings": ((), "SELECT CAST(topping_id AS INTEGER) AS topping_id, topping_name FROM ("
                 + _values(TOPPINGS, ["topping_id", "topping_name"]) + ")"),
    "plans": ((), "SELECT CAST(plan_id AS INTEGER) AS plan_id, plan_name, "
              "CAST(price AS DECIMAL(5,2)) AS price FROM ("
              + _values(PLANS, ["plan_id", "plan_name", "price"]) + ")"),
    "page_hierarchy": ((), "SELECT CAST(page_id AS INTEGER) AS page_id, page_name, "
                       "CAST(product_category AS VARCHAR) AS product_category, "
                       "CAST(product_id AS INTEGER) AS product_id FROM ("
                       + _values(PAGES, ["page_id", "page_name", "product_category",
                                         "product_id"]) + ")"),
    "event_identifier": ((), "SELECT CAST(event_type AS INTEGER) AS event_type, event_name FROM ("
                         + _values(EVENT_TYPES, ["event_type", "event_name"]) + ")"),
    "campaigns": ((), "SELECT CAST(campaign_id AS INTEGER) AS campaign_id, products, campaign_name, "
                  "CAST(start_date AS TIMESTAMP) AS start_date, "
                  "CAST(end_date AS TIMESTAMP) AS end_date FROM ("
                  + _values(CAMPAIGNS, ["campaign_id", "products", "campaign_name",
                                        "start_date", "end_date"]) + ")"),
    "sales": ((), "SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date, "
              "l_partkey AS product_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey"),
    "menu": ((), "SELECT p_partkey AS product_id, p_name AS product_name, "
             "CAST(p_retailprice AS DECIMAL(10,2)) AS price FROM part"),
    "members": ((), "SELECT o_custkey AS customer_id, "
                "CAST(CAST(min(o_orderdate) AS DATE) + 365 AS DATE) AS join_date "
                "FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer "
                "WHERE c_acctbal >= 0) GROUP BY o_custkey"),
    "order_items_raw": ((), "SELECT l_orderkey AS order_id, o_custkey AS customer_id, "
                        "CAST(l_partkey % 2 + 1 AS INTEGER) AS item_type_id, "
                        f"{_list_text('l_linenumber % 6', 'l_suppkey')} AS exclusions, "
                        f"{_list_text('(l_linenumber + 3) % 6', 'l_partkey')} AS extras, "
                        f"{_ORDER_TIME} AS order_time "
                        "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"),
    "runs_raw": ((), f"""SELECT o_orderkey AS order_id,
        CAST(o_custkey % 10 + 1 AS INTEGER) AS runner_id,
        CASE WHEN o_orderkey % 7 = 0 THEN 'null' ELSE strftime({_ORDER_TIME}
             + ((o_orderkey % 60) * 60 + 30) * INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S') END
          AS pickup_time,
        CASE WHEN o_orderkey % 7 = 0 THEN 'null' ELSE
             CAST((o_orderkey % 250 + 10) // 10 AS VARCHAR)
             || CASE WHEN (o_orderkey % 250 + 10) % 10 = 0 THEN ''
                     ELSE '.' || CAST((o_orderkey % 250 + 10) % 10 AS VARCHAR) END
             || CASE o_orderkey % 4 WHEN 0 THEN 'km' WHEN 1 THEN ' km' WHEN 2 THEN '' ELSE 'KM' END
        END AS distance,
        CASE WHEN o_orderkey % 7 = 0 THEN 'null' ELSE
             CAST(o_orderkey % 40 + 10 AS VARCHAR)
             || CASE (o_orderkey // 4) % 5 WHEN 0 THEN 'minutes' WHEN 1 THEN 'mins'
                     WHEN 2 THEN ' minute' WHEN 3 THEN '' ELSE ' MINS' END
        END AS duration,
        CASE WHEN o_orderkey % 7 = 0 THEN
                  CASE WHEN o_orderkey % 2 = 0 THEN 'Restaurant Cancellation'
                       ELSE 'Customer Cancellation' END
             WHEN o_orderkey % 3 = 0 THEN 'null' WHEN o_orderkey % 3 = 1 THEN '' ELSE NULL
        END AS cancellation
        FROM orders"""),
    "runners": ((), "SELECT runner_id, CAST(DATE '2021-01-01' + runner_id * 3 AS DATE) "
                "AS registration_date FROM (SELECT DISTINCT CAST(o_custkey % 10 + 1 AS INTEGER) "
                "AS runner_id FROM orders)"),
    "ratings": ((), "SELECT o_orderkey AS order_id, CAST(o_custkey % 10 + 1 AS INTEGER) AS runner_id, "
                "o_custkey AS customer_id, CAST(o_orderkey % 5 + 1 AS INTEGER) AS rating, "
                f"{_ORDER_TIME} + INTERVAL 2 HOUR AS rating_time "
                "FROM orders WHERE o_orderkey % 7 <> 0"),
    "subscriptions": ((), f"""SELECT customer_id,
        CAST(CASE WHEN o_orderkey = first(o_orderkey) OVER (PARTITION BY customer_id
                       ORDER BY start_date, o_orderkey) THEN 0
             ELSE {_case('o_orderpriority', PRIORITY_PLANS, '1')} END AS INTEGER) AS plan_id,
        start_date
        FROM (SELECT o_custkey AS customer_id, o_orderkey, o_orderpriority,
                     CAST(DATE '2020-01-01'
                          + CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) // 5
                                 AS INTEGER) AS DATE) AS start_date
              FROM orders)"""),
    "weekly_sales_raw": ((), f"""SELECT strftime(wk, '%-d/%-m/%y') AS week_date, region, platform,
        segment, customer_type, CAST(count(*) AS INTEGER) AS transactions,
        CAST(sum(price) AS BIGINT) AS sales
        FROM (SELECT CAST(CAST(date_trunc('week', l_shipdate) AS DATE) + 7308 AS DATE) AS wk,
                     r_name AS region,
                     CASE WHEN l_returnflag = 'R' THEN 'Shopify' ELSE 'Retail' END AS platform,
                     {_case('c_mktsegment', SEGMENT_CODES, "'null'")} AS segment,
                     {_case('o_orderpriority', CUSTOMER_TYPES, "'Guest'")} AS customer_type,
                     CAST(round(l_extendedprice) AS BIGINT) AS price
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey
              JOIN customer ON o_custkey = c_custkey
              JOIN nation ON c_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey)
        GROUP BY wk, region, platform, segment, customer_type"""),
    "users": ((), "SELECT user_id // 3 AS user_id, CAST(user_id AS VARCHAR) AS cookie_id, "
              "min(ts) AS start_date FROM events GROUP BY user_id"),
    "web_events": ((), f"""SELECT CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS visit_id,
        CAST(user_id AS VARCHAR) AS cookie_id,
        CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 13 + 1 AS INTEGER) AS page_id,
        CAST({_case('event_type', EVENT_CODES, 'NULL')} AS INTEGER) AS event_type,
        event_id, ts AS event_time FROM events"""),
}


def with_tables(query: str, *names: str) -> str:
    """``WITH <adapters> <query>``; ``names`` may also list derived CTEs given as
    ``(name, sql)`` pairs, which are appended after the adapters in order."""
    parts = []
    for n in names:
        if isinstance(n, tuple):
            parts.append(f"{n[0]} AS ({n[1]})")
        else:
            parts.append(f"{n} AS ({ADAPTERS[n][1]})")
    return "WITH " + ",\n".join(parts) + "\n" + query


def sql_ratio(num: str, den: str, scale: int = 2, mult: int = 1, precision: int = 18) -> str:
    """DuckDB twin of ``ledgerlens.functions.ratio``: exact half-away-from-zero."""
    m = mult * 10 ** scale
    n = f"CAST(({num}) AS HUGEINT)"
    d = f"CAST(({den}) AS HUGEINT)"
    q = f"((abs({n}) * {2 * m} + abs({d})) // (abs({d}) * 2))"
    signed = f"(CASE WHEN sign({n}) * sign({d}) < 0 THEN -{q} ELSE {q} END)"
    unit = "1" if scale == 0 else "0." + "0" * (scale - 1) + "1"
    return (f"(CASE WHEN ({den}) <> 0 THEN CAST(CAST({signed} AS DECIMAL(38,0)) * {unit} "
            f"AS DECIMAL({precision},{scale})) END)")
