"""Oracle statements of the delivery keys, from the questions. Lists are handled with list
functions over a map of names; changed recipes are worked out once per combination of item
type, exclusions and extras."""

from __future__ import annotations

from .fixtures import sql_ratio, with_tables


def _known(column: str) -> str:
    return f"CASE WHEN lower(trim({column})) NOT IN ('null', 'nan', '') THEN {column} END"


def _ids(column: str) -> str:
    return f"list_transform(string_split({column}, ','), lambda x: TRY_CAST(trim(x) AS BIGINT))"


def _names(column: str) -> str:
    """Names of the ids of a list column, in order, unknown ones left out; ``m`` of topping_map."""
    return f"list_filter(list_transform({_ids(column)}, lambda i: m[i]), lambda n: n IS NOT NULL)"


_ITEMS = ("items", f"""
    SELECT order_id, customer_id, item_type_id, replace({_known('exclusions')}, ' ', '') AS exclusions,
           replace({_known('extras')}, ' ', '') AS extras, order_time FROM order_items_raw""")
_RUNS = ("runs", f"""
    SELECT order_id, runner_id, TRY_CAST({_known('pickup_time')} AS TIMESTAMP) AS pickup_time,
           TRY_CAST(regexp_replace(lower({_known('distance')}), '\\s*km\\s*', '') AS DECIMAL(5,1)) AS distance,
           TRY_CAST(regexp_extract(lower({_known('duration')}), '^\\s*([^m]*[^m\\s])', 1) AS INTEGER) AS duration,
           {_known('cancellation')} AS cancellation FROM runs_raw""")
_DONE = ("done", """
    SELECT i.* FROM items i SEMI JOIN (SELECT order_id FROM runs WHERE cancellation IS NULL) r USING (order_id)""")
_ORDER = ("one_order", """
    SELECT order_id, count(*) AS n, any_value(customer_id) AS customer_id, any_value(order_time) AS order_time
    FROM items GROUP BY order_id""")
_TRIP = ("trip", """
    SELECT r.runner_id, o.*, r.distance, date_diff('minute', o.order_time, r.pickup_time) AS wait
    FROM runs r JOIN one_order o USING (order_id) WHERE r.cancellation IS NULL""")
_MAP = ("topping_map", "SELECT map_from_entries(list((CAST(topping_id AS BIGINT), topping_name))) AS m FROM toppings")
_COMBO = ("combo", f"""
    SELECT c.item_type_id, c.exclusions, c.extras, t.item_name, {_names('c.exclusions')} AS leave_out,
           {_names('c.extras')} AS put_on, {_names('r.toppings')} AS standard
    FROM (SELECT DISTINCT item_type_id, exclusions, extras FROM items) c
    JOIN item_types t USING (item_type_id) LEFT JOIN recipes r USING (item_type_id)
    JOIN topping_map ON TRUE""")
_PLATE = ("plate", """
    SELECT item_type_id, exclusions, extras, item_name, topping, count(*) AS times
    FROM (SELECT *, unnest(list_concat(
              list_filter(coalesce(standard, []), lambda x: NOT list_contains(coalesce(leave_out, []), x)),
              coalesce(put_on, []))) AS topping FROM combo)
    GROUP BY ALL""")

_CLEAN = ("order_items_raw", "runs_raw", _ITEMS, _RUNS, _DONE)
_TRIPS = (*_CLEAN, _ORDER, _TRIP)
_LISTS = (*_CLEAN, "item_types", "recipes", "toppings", _MAP, _COMBO)
_SAME = ("x.item_type_id = i.item_type_id AND x.exclusions IS NOT DISTINCT FROM i.exclusions "
         "AND x.extras IS NOT DISTINCT FROM i.extras")
_PRICE = "if(item_type_id = 1, 12, 10)"
_SPEED = sql_ratio("CAST(distance * 60 AS BIGINT)", "duration", 1)


def _ask(sql: str, *parts) -> str:
    return with_tables(sql, *(parts or _CLEAN))


def _truncated(column: str) -> str:
    return f"CAST(CAST(sum({column}) AS BIGINT) // count({column}) AS INTEGER)"


def _most_named(column: str) -> str:
    return _ask(
        "SELECT topping_name, count(*) AS count_of_topping FROM "
        f"(SELECT unnest({_names(column)}) AS topping_name FROM done JOIN topping_map ON TRUE) GROUP BY topping_name "
        "QUALIFY count(*) = max(count(*)) OVER ()", *_LISTS)


def _count(name: str, sql: str) -> str:
    return f"SELECT '{name}' AS check_name, (SELECT count(*) FROM {sql}) AS violations"


def _repeated(name: str, table: str, key: str) -> str:
    return _count(name, f"(SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1)")


def _unmatched(name: str, child: str, parent: str, key: str) -> str:
    return _count(name, f"{child} ANTI JOIN {parent} USING ({key}) WHERE {key} IS NOT NULL")


ORACLE = {
    "clean_order_items": _ask("SELECT * FROM items"),
    "clean_runs": _ask("SELECT * FROM runs"),
    "delivery_item_count": _ask("SELECT count(order_id) AS order_count FROM items"),
    "delivery_order_count": _ask("SELECT count(*) AS distinct_order_count FROM one_order", *_CLEAN, _ORDER),
    "delivery_success_per_runner": _ask(
        "SELECT runner_id, count(pickup_time) AS delivery_counts FROM runs WHERE cancellation IS NULL "
        "GROUP BY runner_id"),
    "delivery_items_by_type": _ask("SELECT item_type_id, count(*) AS counts FROM done GROUP BY item_type_id"),
    "delivery_items_customer_type": _ask(
        "SELECT customer_id, item_name, count(*) AS item_counts FROM item_types JOIN items USING (item_type_id) "
        "GROUP BY ALL", *_CLEAN, "item_types"),
    "delivery_max_items_per_order": _ask(
        "SELECT max(n) AS max_items FROM one_order SEMI JOIN done USING (order_id)", *_CLEAN, _ORDER),
    "delivery_changed_vs_plain": _ask(
        "SELECT customer_id, count(*) FILTER (changes IS NULL) AS no_change, count(changes) AS with_change "
        "FROM (SELECT customer_id, coalesce(exclusions, extras) AS changes FROM done) GROUP BY customer_id"),
    "delivery_both_changes": _ask("SELECT count(exclusions || extras) AS order_counts FROM done"),
    "delivery_hour_histogram": _ask(
        "SELECT CAST(hour(order_time) AS INTEGER) AS hours_histo, count(*) AS counts_item FROM items GROUP BY ALL"),
    "delivery_weekday_histogram": _ask(
        "SELECT dayname(order_time) AS week_day, count(*) AS counts_item FROM items GROUP BY ALL"),
    "runner_signup_weeks": _ask(
        "SELECT CAST((registration_date - DATE '2020-12-25') // 7 AS INTEGER) AS week_histo, "
        "count(*) AS runners_registering FROM runners GROUP BY ALL", "runners"),
    "runner_pickup_minutes": _ask(
        f"SELECT runner_id AS runner, {_truncated('wait')} AS avg_pickup_time FROM trip GROUP BY runner_id", *_TRIPS),
    "prep_time_by_size": _ask(
        f"SELECT n AS amount_of_items, {_truncated('wait')} AS avg_delivery_time FROM trip GROUP BY n", *_TRIPS),
    "customer_mean_distance": _ask(
        f"SELECT customer_id, {sql_ratio('sum(CAST(distance * 10 AS BIGINT))', 'count(distance) * 10', 2)} "
        "AS avg_distance FROM trip GROUP BY customer_id", *_TRIPS),
    "delivery_duration_spread": _ask(
        "SELECT list_max(d) - list_min(d) AS difference FROM (SELECT list(duration) AS d FROM runs "
        "WHERE cancellation IS NULL)"),
    "runner_speed": _ask(
        f"SELECT runner_id, order_id, CAST(sum({_SPEED}) AS DECIMAL(18,1)) AS avg_speed_kmph FROM runs "
        "WHERE cancellation IS NULL GROUP BY runner_id, order_id"),
    "runner_success_pct": _ask(
        f"SELECT runner_id, {sql_ratio('count(*) - count(cancellation)', 'count(*)', 2, 100)} "
        "AS successful_delivery_percentage FROM runs GROUP BY runner_id"),
    "recipe_ingredients": _ask(
        f"SELECT item_name, unnest({_names('toppings')}) AS topping_name, items_ordered "
        "FROM topping_map JOIN recipes ON TRUE JOIN item_types USING (item_type_id) JOIN (SELECT item_type_id, count(*) AS items_ordered "
        "FROM items GROUP BY item_type_id) USING (item_type_id)", *_LISTS),
    "top_extra_with_ties": _most_named("extras"),
    "top_exclusion_with_ties": _most_named("exclusions"),
    "order_item_label": _ask(
        "SELECT i.order_id, concat(x.item_name, ' - Exclude ' || nullif(array_to_string(x.leave_out, ', '), ''), "
        "' - Extra ' || nullif(array_to_string(x.put_on, ', '), '')) AS receipt "
        f"FROM items i JOIN combo x ON {_SAME}", *_LISTS),
    "order_ingredient_list": _ask(
        "SELECT i.rownum, i.order_id, i.customer_id, x.item_name || ': ' || x.line AS instruction_list, i.order_time "
        "FROM (SELECT *, row_number() OVER (ORDER BY order_id, customer_id, item_type_id, "
        "exclusions NULLS FIRST, extras NULLS FIRST, order_time) AS rownum FROM items) i "
        "JOIN (SELECT item_type_id, exclusions, extras, item_name, string_agg(label, ', ' ORDER BY lower(label), label) "
        "AS line FROM (SELECT *, if(times = 2, '2x', '') || topping AS label FROM plate) "
        f"GROUP BY item_type_id, exclusions, extras, item_name) x ON {_SAME}", *_LISTS, _PLATE),
    "ingredient_totals": _ask(
        "SELECT topping AS atomic_topping_name, CAST(sum(times) AS BIGINT) AS total_used_ingredient "
        f"FROM done i JOIN plate x ON {_SAME} GROUP BY topping", *_LISTS, _PLATE),
    "revenue_base": _ask(f"SELECT CAST(sum({_PRICE}) AS BIGINT) AS total_rev FROM done"),
    "revenue_with_extras": _ask(
        f"SELECT CAST(sum({_PRICE} + coalesce(len(string_split(extras, ',')), 0)) AS BIGINT) AS total_rev FROM done"),
    "ratings_contract": _ask(" UNION ALL ".join([
        _repeated("pk_ratings_order_id", "ratings", "order_id"), _repeated("pk_runs_order_id", "runs", "order_id"),
        _repeated("pk_runners_runner_id", "runners", "runner_id"), _repeated("pk_items_order_id", "items", "order_id"),
        _unmatched("fk_ratings_runs", "ratings", "runs", "order_id"),
        _unmatched("fk_ratings_runners", "ratings", "runners", "runner_id"),
        _unmatched("fk_runs_ratings", "runs", "ratings", "order_id"),
        _count("not_null_ratings", "ratings WHERE order_id + runner_id + customer_id IS NULL"),
        _count("chk_ratings_rating", "ratings WHERE rating < 1 OR rating > 5"),
        _count("not_null_runs_order_id", "runs WHERE order_id IS NULL"),
        _count("not_null_runs_pickup_time", "runs WHERE pickup_time IS NULL"),
        _count("chk_runs_duration", "runs WHERE duration < 1 OR duration > 30"),
    ]), *_CLEAN, "ratings", "runners"),
    "delivery_report": _ask(
        "SELECT DISTINCT g.customer_id, order_id, g.runner_id, g.rating, o.order_time, r.pickup_time, "
        "CAST(date_diff('minute', o.order_time, r.pickup_time) AS INTEGER) AS order_pick_diff, r.duration, "
        f"{_SPEED} AS avg_speed_kmph, o.n AS total_number_of_items "
        "FROM ratings g JOIN runs r USING (order_id) JOIN one_order o USING (order_id)", *_CLEAN, "ratings", _ORDER),
    "net_profit": _ask(
        f"SELECT CAST((SELECT sum({_PRICE}) FROM done) - (SELECT sum(CAST(distance * 0.30 AS DECIMAL(38,2))) "
        "FROM runs WHERE cancellation IS NULL) AS DECIMAL(38,2)) AS total_rev"),
}
