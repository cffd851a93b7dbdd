"""Loyalty and sales analysis (the case-1 catalogue).

Shapes: ``sales(customer_id, order_date, product_id)``,
``menu(product_id, product_name, price)``, ``members(customer_id, join_date)``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.asof import asof_first, asof_last, join_before
from ..operators.ranking import top_k, top_per_group
from ..sources.sinks import register_view

# Parameters of the points rules: points per unit of price, the product that
# always earns double, the length of the double-points first week, and the
# statement cutoff (exclusive).
POINTS_PER_UNIT = 10
BONUS_PRODUCT = "red plate"
FIRST_WEEK_DAYS = 7
POINTS_CUTOFF = dt.date(2000, 1, 1)

MONEY = "decimal(38,2)"


def _priced(sales: DataFrame, menu: DataFrame) -> DataFrame:
    return sales.join(menu, "product_id")


def total_spend(sales, menu):
    return (_priced(sales, menu).groupBy("customer_id")
            .agg(F.sum("price").cast(MONEY).alias("totalspent")))


def visit_days(sales):
    return sales.groupBy("customer_id").agg(F.countDistinct("order_date").alias("visit_amount"))


def first_items(sales, menu):
    """Products of each customer's first date; names are joined to the few rows left."""
    first = sales.groupBy("customer_id").agg(F.min("order_date").alias("order_date"))
    firsts = sales.join(first, ["customer_id", "order_date"]).select("customer_id", "product_id").distinct()
    return firsts.join(menu, "product_id").select("customer_id", "product_name").distinct()


def _item_counts(sales, menu, *by):
    """Sales per product name (and ``by``): counted per product before the name is joined."""
    counts = sales.groupBy(*by, "product_id").agg(F.count(F.lit(1)).alias("__n"))
    return counts.join(menu.select("product_id", "product_name"), "product_id") \
        .groupBy(*by, "product_name").agg(F.sum("__n").alias("__n"))


def top_item(sales, menu, place: int = 1):
    """The most purchased product, or the one at another ``place``."""
    counts = _item_counts(sales, menu).select("product_name", F.col("__n").alias("purchase_count"))
    return top_k(counts, 1, [F.desc("purchase_count"), F.asc("product_name")], offset=place - 1)


def favourite_per_customer(sales, menu):
    counts = _item_counts(sales, menu, "customer_id").withColumnRenamed("__n", "product_count") \
        .select("customer_id", "product_name", "product_count")
    return top_per_group(counts, ["customer_id"], [F.desc("product_count")]).orderBy("customer_id")


def first_after_join(sales, menu, members):
    firsts = asof_first(sales, members, "customer_id", "order_date", "join_date")
    return firsts.join(menu, "product_id").select(F.col("customer_id").alias("customer"),
                                                  "product_name")


def last_before_join(sales, menu, members):
    lasts = asof_last(sales, members, "customer_id", "order_date", "join_date")
    return lasts.join(menu, "product_id").select(F.col("customer_id").alias("customer"),
                                                 F.col("product_name").alias("product"))


def spend_before_join(sales, menu, members):
    before = join_before(sales, members, "customer_id", "order_date", "join_date")
    return (before.join(menu, "product_id").groupBy("customer_id")
            .agg(F.count("product_id").alias("total_count"),
                 F.sum("price").cast(MONEY).alias("total_spent")))


def _base_points(bonus_product: str):
    unit = F.col("price") * POINTS_PER_UNIT
    return F.when(F.col("product_name") == bonus_product, unit * 2).otherwise(unit)


def points(sales, menu, bonus_product: str = BONUS_PRODUCT):
    return (_priced(sales, menu).groupBy("customer_id")
            .agg(F.sum(_base_points(bonus_product)).cast(MONEY).alias("points")))


def points_first_week(sales, menu, members, cutoff=POINTS_CUTOFF,
                      bonus_product: str = BONUS_PRODUCT):
    """First-week double points take priority over the product bonus."""
    j = _priced(sales, menu).join(members, "customer_id").where(F.col("order_date") < F.lit(cutoff))
    unit = F.col("price") * POINTS_PER_UNIT
    first_week = F.col("order_date").between(
        F.col("join_date"), F.date_add("join_date", FIRST_WEEK_DAYS - 1))
    pts = F.when(first_week, unit * 2).otherwise(_base_points(bonus_product))
    return j.groupBy("customer_id").agg(F.sum(pts).cast(MONEY).alias("members_points"))


def joined_view(sales, menu, members):
    j = _priced(sales, menu).join(members, "customer_id", "left")
    member = F.when((F.col("order_date") < F.col("join_date")) | F.col("join_date").isNull(),
                    F.lit("N")).otherwise(F.lit("Y"))
    return j.select("customer_id", "order_date", "product_name", "price", member.alias("member"))


def member_ranking(sales, menu, members):
    """Dense rank of member-period purchases by date per customer; NULL for
    purchases made as a non-member. Ranks come from the distinct purchase
    dates, before any product is joined, so one very active customer does not
    sort all its rows in one task."""
    dates = sales.select("customer_id", "order_date").distinct()
    member_dates = join_before(dates, members, "customer_id", "order_date", "join_date", on_or_after=True)
    order = Window.partitionBy("customer_id").orderBy("order_date")
    ranks = member_dates.select("customer_id", "order_date",
                                F.dense_rank().over(order).cast("bigint").alias("ranking"))
    j = _priced(sales, menu).join(ranks, ["customer_id", "order_date"], "left")
    return j.select("customer_id", "order_date", "product_name", "price",
                    F.when(F.col("ranking").isNull(), "N").otherwise("Y").alias("member"), "ranking")


def view_summary(sales, menu, members, name: str = "member_purchases"):
    """Register the joined view under ``name`` and ask it from a second statement."""
    view = register_view(joined_view(sales, menu, members), name)
    return view.sparkSession.sql(
        f"SELECT member, count(*) AS items, CAST(sum(price) AS {MONEY}) AS spent FROM {name} GROUP BY member")
