"""Delivery operations: cleaning, metrics, list-valued items, pricing (the case-2 catalogue).

Shapes: ``order_items(order_id, customer_id, item_type_id, exclusions, extras,
order_time)`` with CSV id lists, ``runs(order_id, runner_id, pickup_time,
distance, duration, cancellation)`` as dirty text, ``runners``,
``item_types(item_type_id, item_name)``, ``recipes(item_type_id, toppings)``,
``toppings(topping_id, topping_name)``, ``ratings``.

The cleaned tables are narrow projections. Lists are edited once per distinct
(item type, exclusions, extras): the items are counted or joined by that
combination. Questions about orders aggregate the items once per order and
join that to the runs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (concat_nullsafe, day_bucket, leading_number, minute_boundaries,
                         normalize_null, numeric_before_unit, ratio, strip_spaces,
                         truncated_avg, weekday_name, weekday_number)
from ..operators import lists as L
from ..operators import quality as Q
from ..operators.numbering import surrogate_key
from ..operators.ranking import top_k_with_ties
from ..operators.sizing import fixed_dimension

# Pricing parameters: price of item type 1 and of the others, price per extra,
# runner pay per km; the runner sign-up week anchor.
PRICE_TYPE_1 = 12
PRICE_OTHER = 10
PRICE_PER_EXTRA = 1
PAY_PER_KM = "0.30"
SIGNUP_ANCHOR = dt.date(2021, 1, 1)


# -- cleaning -----------------------------------------------------------------
def clean_order_items(raw: DataFrame) -> DataFrame:
    return raw.select("order_id", "customer_id", "item_type_id",
                      strip_spaces(normalize_null("exclusions")).alias("exclusions"),
                      strip_spaces(normalize_null("extras")).alias("extras"),
                      "order_time")


def clean_runs(raw: DataFrame) -> DataFrame:
    """Null tokens to NULL, units stripped ('20km', '25mins'), typed columns;
    unparseable values become NULL."""
    dist = numeric_before_unit(normalize_null("distance"), "km")
    dur = leading_number(normalize_null("duration"), "m")
    return raw.select("order_id", "runner_id",
                      normalize_null("pickup_time").try_cast("timestamp_ntz").alias("pickup_time"),
                      dist.try_cast("decimal(5,1)").alias("distance"),
                      dur.try_cast("int").alias("duration"),
                      normalize_null("cancellation").alias("cancellation"))


def _delivered(runs: DataFrame) -> DataFrame:
    return runs.where(F.col("cancellation").isNull())


def _delivered_items(items: DataFrame, runs: DataFrame) -> DataFrame:
    return items.join(_delivered(runs).select("order_id"), "order_id", "left_semi")


# -- metrics --------------------------------------------------------------------
def item_count(items):
    return items.agg(F.count("order_id").alias("order_count"))


def order_count(items):
    return items.agg(F.countDistinct("order_id").alias("distinct_order_count"))


def success_per_runner(runs):
    return _delivered(runs).groupBy("runner_id").agg(F.count("pickup_time").alias("delivery_counts"))


def items_by_type(items, runs):
    return (_delivered_items(items, runs).groupBy("item_type_id")
            .agg(F.count(F.lit(1)).alias("counts")))


def items_customer_type(items, item_types):
    return (items.join(fixed_dimension(item_types), "item_type_id")
            .groupBy("customer_id", "item_name").agg(F.count("item_name").alias("item_counts"))
            .orderBy("customer_id", "item_name"))


def max_items_per_order(items, runs):
    per_order = _delivered_items(items, runs).groupBy("order_id").agg(
        F.count("order_id").alias("counts"))
    return per_order.agg(F.max("counts").alias("max_items"))


def changed_vs_plain(items, runs):
    plain = F.col("exclusions").isNull() & F.col("extras").isNull()
    return (_delivered_items(items, runs).groupBy("customer_id")
            .agg(F.sum(F.when(plain, 1).otherwise(0)).alias("no_change"),
                 F.sum(F.when(~plain, 1).otherwise(0)).alias("with_change")))


def both_changes(items, runs):
    both = F.col("extras").isNotNull() & F.col("exclusions").isNotNull()
    return _delivered_items(items, runs).where(both).agg(F.count(F.lit(1)).alias("order_counts"))


def hour_histogram(items):
    return (items.groupBy(F.hour("order_time").alias("hours_histo"))
            .agg(F.count(F.lit(1)).alias("counts_item")).orderBy("hours_histo"))


def weekday_histogram(items):
    return (items.groupBy(weekday_name("order_time").alias("week_day"),
                          weekday_number("order_time").alias("__n"))
            .agg(F.count(F.lit(1)).alias("counts_item")).orderBy("__n").drop("__n"))


def signup_weeks(runners, anchor=SIGNUP_ANCHOR):
    return (runners.groupBy(day_bucket(F.lit(anchor), F.col("registration_date")).alias("week_histo"))
            .agg(F.count(F.lit(1)).alias("runners_registering")))


def _per_order(items):
    """One row per order: number of items, order time, customer."""
    return items.groupBy("order_id").agg(F.count("order_id").alias("n_items"),
                                         F.min("order_time").alias("order_time"),
                                         F.min("customer_id").alias("customer_id"))


def _pickups(items, runs):
    """One row per delivered order with its minute-boundary pickup delay."""
    j = _delivered(runs).select("order_id", "runner_id", "pickup_time", "distance") \
        .join(_per_order(items), "order_id")
    return j.withColumn("picktime", minute_boundaries("order_time", "pickup_time"))


def pickup_minutes(items, runs):
    return (_pickups(items, runs).groupBy(F.col("runner_id").alias("runner"))
            .agg(truncated_avg("picktime").alias("avg_pickup_time")))


def prep_time_by_size(items, runs):
    return (_pickups(items, runs).groupBy(F.col("n_items").alias("amount_of_items"))
            .agg(truncated_avg("picktime").alias("avg_delivery_time")))


def customer_mean_distance(items, runs):
    """Mean distance per customer over delivered orders."""
    tenths = (F.col("distance") * 10).cast("bigint")
    return _pickups(items, runs).groupBy("customer_id").agg(
        ratio(F.sum(tenths), F.count("distance") * 10, 2).alias("avg_distance"))


def duration_spread(runs):
    return _delivered(runs).agg((F.max("duration") - F.min("duration")).alias("difference"))


def _speed():
    """km/h = distance / (minutes / 60), exact from tenths of a km."""
    return ratio((F.col("distance") * 10).cast("bigint") * 6, F.col("duration"), 1)


def runner_speed(runs):
    """Speed per runner and order, summed over the order's runs."""
    return (_delivered(runs).groupBy("runner_id", "order_id")
            .agg(F.sum(_speed()).cast("decimal(18,1)").alias("avg_speed_kmph"))
            .orderBy("runner_id", "order_id"))


def success_pct(runs):
    ok = F.sum(F.when(F.col("cancellation").isNull(), 1).otherwise(0))
    return runs.groupBy("runner_id").agg(
        ratio(ok, F.count(F.lit(1)), 2, 100).alias("successful_delivery_percentage"))


# -- item lists -----------------------------------------------------------------
def recipe_ingredients(recipes, item_types, toppings, items):
    """Standard ingredients per item type, with how many items of the type were ordered."""
    ordered = items.groupBy("item_type_id").agg(F.count(F.lit(1)).alias("items_ordered"))
    e = L.explode_list(recipes, "toppings", toppings, "topping_id", "topping_name", "topping_name")
    return (e.join(fixed_dimension(item_types), "item_type_id").join(ordered, "item_type_id")
            .select("item_name", "topping_name", "items_ordered"))


def _top_list_item(items, runs, toppings, col):
    delivered = _delivered_items(items, runs).where(F.col(col).isNotNull())
    named = L.explode_list(delivered, col, toppings, "topping_id", "topping_name", "topping_name")
    counts = named.groupBy("topping_name").agg(F.count("topping_name").alias("count_of_topping"))
    return top_k_with_ties(counts, 1, [F.desc("count_of_topping")])


def top_extra(items, runs, toppings):
    return _top_list_item(items, runs, toppings, "extras")


def top_exclusion(items, runs, toppings):
    return _top_list_item(items, runs, toppings, "exclusions")


_COMBINATION = ("item_type_id", "exclusions", "extras")


def _combinations(items) -> DataFrame:
    """Distinct (item type, exclusions, extras) with their number of items (``n``)."""
    return items.groupBy(*_COMBINATION).agg(F.count(F.lit(1)).alias("n"))


def _back_to_items(items, combos) -> DataFrame:
    """Items with the other columns of their combination."""
    keys = combos.select(*[F.col(c).alias(f"__{c}") for c in _COMBINATION],
                         *[c for c in combos.columns if c not in (*_COMBINATION, "n")])
    met = F.lit(True)
    for c in _COMBINATION:
        met = met & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return items.join(keys, met).drop(*[f"__{c}" for c in _COMBINATION])


_CHANGES = {"__excl": "exclusions", "__extra": "extras"}


def _named(combos, toppings, **more) -> DataFrame:
    return L.with_all_names(combos, {**_CHANGES, **more}, toppings, "topping_id", "topping_name")


def item_label(items, item_types, toppings):
    """'Name - Exclude a, b - Extra c' per ordered item."""
    combos = _named(_combinations(items), toppings).join(fixed_dimension(item_types), "item_type_id")
    excl, extra = L.join_names(F.col("__excl")), L.join_names(F.col("__extra"))
    receipt = concat_nullsafe("item_name", F.concat(F.lit(" - Exclude "), excl),
                              F.concat(F.lit(" - Extra "), extra))
    labelled = combos.select(*_COMBINATION, receipt.alias("receipt"))
    return _back_to_items(items, labelled).select("order_id", "receipt")


def _final_bags(combos, recipes, toppings) -> DataFrame:
    """Each combination's ingredient bag (``__atomic``): recipe minus exclusions plus extras. The
    combinations are worked out once; their three lists are looked up together."""
    whole = combos.join(fixed_dimension(recipes.select("item_type_id", F.col("toppings").alias("__toppings"))),
                        "item_type_id", "left")
    named = _named(whole, toppings, __recipe="__toppings")
    return L.edit_lists(named, F.col("__recipe"), F.col("__excl"), F.col("__extra"), "__atomic") \
        .drop("__recipe", "__excl", "__extra", "__toppings")


def ingredient_list(items, item_types, recipes, toppings, prefix_all: bool = False):
    """Alphabetical (case-insensitive) ingredient list per item with '2x'
    marks, numbered by a consecutive key over the full row order."""
    labels = L.case_insensitive_sort(L.mark_repeats(F.col("__atomic"), 2, prefix_all))
    known = items.join(fixed_dimension(item_types.select("item_type_id")), "item_type_id", "left_semi")
    bags = (_final_bags(_combinations(known), recipes, toppings)
            .join(fixed_dimension(item_types), "item_type_id")
            .select(*_COMBINATION, F.size("__atomic").alias("__size"),
                    F.concat(F.col("item_name"), F.lit(": "), F.array_join(labels, ", "))
                    .alias("instruction_list")))
    order = [F.col(c).asc_nulls_first() for c in
             ("customer_id", "item_type_id", "exclusions", "extras", "order_time")]
    keyed = _back_to_items(surrogate_key(known, "order_id", order, "rownum"), bags)
    return keyed.where(F.col("__size") > 0).select("rownum", "order_id", "customer_id",
                                                   "instruction_list", "order_time")


def ingredient_totals(items, runs, recipes, toppings):
    bags = _final_bags(_combinations(_delivered_items(items, runs)), recipes, toppings)
    # explode_outer + NULL filter: an inner explode would make the optimizer
    # add a pushed-down size(array) > 0 filter that evaluates the edit twice.
    return (bags.select("n", F.explode_outer("__atomic").alias("atomic_topping_name"))
            .where(F.col("atomic_topping_name").isNotNull())
            .groupBy("atomic_topping_name").agg(F.sum("n").alias("total_used_ingredient"))
            .orderBy(F.desc("total_used_ingredient"), "atomic_topping_name"))


# -- pricing and ratings --------------------------------------------------------
def _price():
    return F.when(F.col("item_type_id") == 1, PRICE_TYPE_1).otherwise(PRICE_OTHER)


def revenue_base(items, runs):
    return _delivered_items(items, runs).agg(F.sum(_price()).alias("total_rev"))


def revenue_with_extras(items, runs):
    d = _delivered_items(items, runs)
    return d.agg((F.sum(_price()) + F.sum(L.list_size("extras") * PRICE_PER_EXTRA))
                 .alias("total_rev"))


def ratings_contract(ratings, runs, runners, items):
    """Checks of the ratings table contract (key, not-null, references, 1..5), of the keys
    declared on its parents, and of rules that the delivery data breaks: cancelled runs have
    neither a pickup time nor a rating, an order has several items, some runs take long."""
    return Q.one_pass_report(
        {"ratings": ratings, "runs": runs, "runners": runners, "items": items},
        primary={"pk_ratings_order_id": ("ratings", "order_id"), "pk_runs_order_id": ("runs", "order_id"),
                 "pk_runners_runner_id": ("runners", "runner_id"), "pk_items_order_id": ("items", "order_id")},
        foreign={"fk_ratings_runs": ("ratings", "order_id", "runs", "order_id"),
                 "fk_ratings_runners": ("ratings", "runner_id", "runners", "runner_id"),
                 "fk_runs_ratings": ("runs", "order_id", "ratings", "order_id")},
        rows={"not_null_ratings": ("ratings", Q.any_null(["order_id", "runner_id", "customer_id"])),
              "chk_ratings_rating": ("ratings", Q.outside("rating", 1, 5)),
              "not_null_runs_order_id": ("runs", Q.any_null(["order_id"])),
              "not_null_runs_pickup_time": ("runs", Q.any_null(["pickup_time"])),
              "chk_runs_duration": ("runs", Q.outside("duration", 1, 30))})


def rating_rules():
    """What a row of the ratings table must hold to be loaded (see ``sinks.load_checked``)."""
    return {"not_null": ~Q.any_null(["order_id", "runner_id", "customer_id"]),
            "rating_1_to_5": ~F.coalesce(Q.outside("rating", 1, 5), F.lit(False))}


def delivery_report(ratings, runs, items):
    """One row per rated order with times, delay, speed and item count."""
    j = (ratings.select("customer_id", "order_id", "runner_id", "rating")
         .join(runs.select("order_id", "pickup_time", "duration", "distance"), "order_id")
         .join(_per_order(items).drop("customer_id"), "order_id"))
    return j.select("customer_id", "order_id", "runner_id", "rating", "order_time", "pickup_time",
                    minute_boundaries("order_time", "pickup_time").alias("order_pick_diff"),
                    "duration", _speed().alias("avg_speed_kmph"),
                    F.col("n_items").alias("total_number_of_items")).distinct()


def net_profit(items, runs):
    """Revenue of delivered items minus runner pay per km of delivered runs.

    The two one-row aggregates are stacked and summed (no join needed)."""
    money = "decimal(38,2)"
    rev = _delivered_items(items, runs).select(
        _price().cast(money).alias("revenue"), F.lit(None).cast(money).alias("pay"))
    pay = _delivered(runs).select(
        F.lit(None).cast(money).alias("revenue"),
        (F.col("distance") * F.lit(PAY_PER_KM).cast("decimal(3,2)")).cast(money).alias("pay"))
    return rev.unionByName(pay).agg(
        (F.sum("revenue") - F.sum("pay")).cast(money).alias("total_rev"))
