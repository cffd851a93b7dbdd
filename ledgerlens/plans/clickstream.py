"""Clickstream funnel and campaign analysis (the case-6 catalogue).

Event codes: 1 page view, 2 add to cart, 3 purchase, 4 ad impression, 5 ad click.
Shapes: ``events(visit_id, cookie_id, page_id, event_type, sequence_number,
event_time)``, ``pages(page_id, page_name, product_category, product_id)``,
``users(user_id, cookie_id, start_date)``, ``campaigns(.., start_date, end_date)``.

Plan shape: every visit-level question aggregates the events once per visit
(map-side partial aggregation), joins the bounded dimensions by broadcast, and
only then does the small per-product / per-campaign aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import month_name, ratio
from ..operators.intervals import interval_join
from ..operators.ranking import top_k
from ..operators.sizing import fixed_dimension

VIEW, CART, PURCHASE, IMPRESSION, CLICK = 1, 2, 3, 4, 5
CHECKOUT_PAGE = 12


def _flag(cond):
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


# -- digital analysis -------------------------------------------------------
def distinct_users(users: DataFrame) -> DataFrame:
    return users.agg(F.countDistinct("user_id").alias("user_count"))


def cookies_per_user(users: DataFrame) -> DataFrame:
    return users.agg(F.count("cookie_id").alias("cookie_counts"),
                     F.countDistinct("user_id").alias("user_counts"),
                     ratio(F.countDistinct("cookie_id"), F.countDistinct("user_id"), 6)
                     .alias("avg_cookie"))


def visits_by_month(events: DataFrame) -> DataFrame:
    return (events.groupBy(month_name("event_time").alias("month"),
                           F.month("event_time").alias("month_number"))
            .agg(F.countDistinct("visit_id").alias("visit_count"))
            .orderBy("month_number").select("month", "visit_count"))


def events_by_type(events: DataFrame, event_names: DataFrame) -> DataFrame:
    return (events.join(fixed_dimension(event_names), "event_type")
            .groupBy("event_name").agg(F.count(F.lit(1)).alias("event_count")))


def visit_flags(events: DataFrame) -> DataFrame:
    """One row per visit with purchase / checkout-view / checkout-touch flags."""
    return events.groupBy("visit_id").agg(
        F.max(_flag(F.col("event_type") == PURCHASE)).alias("purchased"),
        F.max(_flag((F.col("event_type") == VIEW) & (F.col("page_id") == CHECKOUT_PAGE)))
        .alias("checkout_view"),
        F.max(_flag(F.col("page_id") == CHECKOUT_PAGE)).alias("checkout_touch"))


def purchase_visit_pct(events: DataFrame) -> DataFrame:
    v = visit_flags(events)
    return v.agg(ratio(F.sum("purchased"), F.count(F.lit(1)), 2, 100).alias("purchase_percentage"))


def checkout_abandonment(events: DataFrame, over: str = "all") -> DataFrame:
    """Visits that viewed checkout without a purchase, as a percent of all
    visits (``over='all'``) or of visits that touched the checkout page."""
    v = visit_flags(events)
    abandoned = F.sum(F.col("checkout_view") * (1 - F.col("purchased")))
    den = F.count(F.lit(1)) if over == "all" else F.sum("checkout_touch")
    return v.agg(ratio(abandoned, den, 2, 100).alias("checkout_no_purchase"))


def top_pages_by_views(events: DataFrame, pages: DataFrame, k: int = 3) -> DataFrame:
    counts = (events.where(F.col("event_type") == VIEW)
              .join(fixed_dimension(pages), "page_id")
              .groupBy("page_name").agg(F.count(F.lit(1)).alias("view_count")))
    return top_k(counts, k, [F.desc("view_count"), F.asc("page_name")])


def category_views_carts(events: DataFrame, pages: DataFrame) -> DataFrame:
    return (events.join(fixed_dimension(pages.where(F.col("product_category").isNotNull())),
                        "page_id")
            .groupBy("product_category")
            .agg(F.sum(_flag(F.col("event_type") == VIEW)).alias("view_count"),
                 F.sum(_flag(F.col("event_type") == CART)).alias("add_cart_count")))


def visit_pages(events: DataFrame) -> DataFrame:
    """One row per visit and page: how often it was viewed and put in the cart, and whether
    the visit's purchase happened on it."""
    et = F.col("event_type")
    return events.groupBy("visit_id", "page_id").agg(
        F.sum(_flag(et == VIEW)).alias("views"), F.sum(_flag(et == CART)).alias("carts"),
        F.max(_flag(et == PURCHASE)).alias("purchased"))


def pages_of_visits(pages_seen: DataFrame) -> DataFrame:
    """Rows of :func:`visit_pages` with ``purchased`` true for the whole visit. A visit's list
    holds a page once, so it is bounded by the pages there are."""
    visits = pages_seen.groupBy("visit_id").agg(
        F.collect_list(F.struct("page_id", "views", "carts")).alias("seen"),
        F.max("purchased").alias("purchased"))
    return visits.select(F.explode("seen").alias("p"), "purchased") \
        .select("p.page_id", "p.views", "p.carts", "purchased")


def top_purchased(events: DataFrame, pages: DataFrame, k: int = 3) -> DataFrame:
    bought = pages_of_visits(visit_pages(events)).where((F.col("purchased") == 1) & (F.col("carts") > 0))
    counts = (bought.join(fixed_dimension(pages), "page_id")
              .groupBy("page_name").agg(F.sum("carts").alias("purchase_count")))
    return top_k(counts, k, [F.desc("purchase_count"), F.asc("page_name")])


# -- product funnel -----------------------------------------------------------
def product_funnel(events: DataFrame, pages: DataFrame, event_names: DataFrame) -> DataFrame:
    """Views, cart adds, purchases and abandoned carts per product, counted in
    distinct visits. A cart add is purchased when its visit has a purchase."""
    known = events.join(fixed_dimension(event_names.select("event_type")), "event_type", "left_semi")
    return funnel_of(visit_pages(known), pages)


def funnel_of(pages_seen: DataFrame, pages: DataFrame) -> DataFrame:
    """The product funnel from rows of :func:`visit_pages`."""
    known = pages_seen.join(fixed_dimension(pages.select("page_id")), "page_id", "left_semi")
    touched = pages_of_visits(known)
    agg = touched.groupBy("page_id").agg(
        F.count_if(F.col("views") > 0).alias("product_views"),
        F.count_if(F.col("carts") > 0).alias("added_to_cart"),
        F.count_if((F.col("carts") > 0) & (F.col("purchased") == 1)).alias("purchased_product"))
    products = fixed_dimension(pages.where(F.col("product_id").isNotNull()))
    return products.join(agg, "page_id").select(
        "product_category", "page_name", "product_views", "added_to_cart", "purchased_product",
        (F.col("added_to_cart") - F.col("purchased_product")).alias("abandoned_count"))


def category_funnel(funnel: DataFrame) -> DataFrame:
    """Re-aggregate the product funnel per category (sums of per-product counts)."""
    return funnel.groupBy("product_category").agg(
        F.sum("product_views").alias("category_views"),
        F.sum("added_to_cart").alias("carted_category_products"),
        F.sum("purchased_product").alias("purchased_category_products"),
        F.sum("abandoned_count").alias("abandoned_category_products"))


def funnel_leaders(funnel: DataFrame) -> DataFrame:
    """Leader per metric, ties kept. The funnel has one row per product, so the
    unpartitioned rank runs over a dimension-sized frame."""
    metrics = [("Most Viewed", "product_views"), ("Most Carted", "added_to_cart"),
               ("Most Purchased", "purchased_product")]
    stacked = funnel.select("page_name", F.explode(F.array(*[
        F.struct(F.lit(label).alias("metric"), F.col(c).alias("metric_value"))
        for label, c in metrics])).alias("m")).select("m.metric", "page_name", "m.metric_value")
    rnk = F.rank().over(Window.partitionBy("metric").orderBy(F.desc("metric_value")))
    return stacked.withColumn("r", rnk).where("r = 1").drop("r")


def funnel_top_rate(funnel: DataFrame, num: str, den: str, name: str) -> DataFrame:
    rated = funnel.select("page_name", ratio(F.col(num), F.col(den), 2, 100).alias(name))
    return top_k(rated, 1, [F.desc_nulls_last(name), F.asc("page_name")])


def funnel_mean_rate(funnel: DataFrame, num: str, den: str, name: str) -> DataFrame:
    per = F.try_divide(F.col(num).cast("double") * 100, F.col(den).cast("double"))
    return funnel.agg(F.avg(per).cast("decimal(18,2)").alias(name))


# -- campaigns ------------------------------------------------------------------
def campaign_summary(events: DataFrame, users: DataFrame, pages: DataFrame,
                     event_names: DataFrame, campaigns: DataFrame) -> DataFrame:
    """One row per visit and user: counts, purchase flag, campaign by visit start time, and
    the cart products in event order.

    Events are first aggregated per visit and cookie, where they lie; the users of the cookies
    are joined to those rows, and the cookies of one user in a visit are put together."""
    ev = (events.join(fixed_dimension(event_names.select("event_type")), "event_type", "left_semi")
          .join(fixed_dimension(pages.select("page_id", "page_name")), "page_id", "left"))
    et = F.col("event_type")
    carted = F.when((et == CART) & F.col("page_name").isNotNull(),
                    F.struct("event_time", "event_id", "page_name"))
    per_cookie = ev.groupBy("visit_id", "cookie_id").agg(
        F.min("event_time").alias("visit_start_time"),
        F.sum(_flag(et == VIEW)).alias("page_views"), F.sum(_flag(et == CART)).alias("cart_adds"),
        F.max(_flag(et == PURCHASE)).alias("purchase"),
        F.sum(_flag(et == IMPRESSION)).alias("impression"), F.sum(_flag(et == CLICK)).alias("click"),
        F.collect_list(carted).alias("carts"))
    per_visit = (per_cookie.join(users.select("cookie_id", "user_id"), "cookie_id")
                 .groupBy("visit_id", "user_id").agg(
        F.min("visit_start_time").alias("visit_start_time"),
        *[F.sum(c).cast("bigint").alias(c) for c in ("page_views", "cart_adds")],
        F.max("purchase").alias("purchase"),
        *[F.sum(c).cast("bigint").alias(c) for c in ("impression", "click")],
        F.array_sort(F.flatten(F.collect_list("carts"))).alias("carts")))
    names = F.transform("carts", lambda s: s["page_name"])
    per_visit = per_visit.withColumn("cart_products", F.when(F.size("carts") > 0, F.array_join(names, ", ")))
    matched = interval_join(per_visit, "visit_start_time",
                            campaigns.select("campaign_name", "start_date", "end_date"),
                            "start_date", "end_date", how="left", point_key=["visit_id", "user_id"])
    return matched.select("user_id", "visit_id", "visit_start_time", "page_views", "cart_adds",
                          "purchase", "campaign_name", "impression", "click", "cart_products")


def impression_impact(summary: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return (summary.where(F.col("campaign_name").isNotNull())
            .groupBy(F.when(F.col("impression") >= 1, "Yes").otherwise("No").alias("impressions"),
                     "campaign_name")
            .agg(ratio(F.sum("page_views"), n, 2).alias("page_view_avg"),
                 ratio(F.sum("cart_adds"), n, 2).alias("cart_adds_avg"),
                 ratio(F.sum("purchase"), n, 2, 100).alias("avg_purchase_percent"))
            .orderBy("campaign_name"))


def interaction_purchase(summary: DataFrame) -> DataFrame:
    tier = (F.when(F.col("click") >= 1, "Clicked").when(F.col("impression") >= 1, "Impression Only")
            .otherwise("No Impression"))
    return (summary.groupBy(tier.alias("interaction_type"))
            .agg(ratio(F.sum("purchase"), F.count(F.lit(1)), 2, 100).alias("purchase_percent")))


def campaign_scorecard(summary: DataFrame) -> DataFrame:
    """Lift of purchase rate with vs without impressions, impressions, click rate.

    With p1/n1 the purchases/visits with an impression and p0/n0 without,
    lift = (p1/n1 - p0/n0) / (p0/n0) * 100 = (p1*n0 - p0*n1) * 100 / (n1*p0),
    computed exactly; a zero baseline gives NULL instead of an error."""
    imp = F.col("impression") >= 1
    p1 = F.sum(F.when(imp, F.col("purchase")).otherwise(0))
    n1 = F.sum(_flag(imp))
    p0 = F.sum(F.when(~imp, F.col("purchase")).otherwise(0))
    n0 = F.sum(_flag(~imp))
    # counts are below 10 ** 19, so their products fit the widest decimal
    p1, n1, p0, n0 = (c.cast("decimal(19,0)") for c in (p1, n1, p0, n0))
    return (summary.where(F.col("campaign_name").isNotNull()).groupBy("campaign_name")
            .agg(ratio(p1 * n0 - p0 * n1, n1 * p0, 2, 100).alias("lift"),
                 F.sum("impression").alias("total_impression"),
                 ratio(F.sum("click"), F.sum("impression"), 2, 100)
                 .alias("impression_to_click_rate")))
