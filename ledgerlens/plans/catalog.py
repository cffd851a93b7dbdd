"""Catalogue: key -> Spark callable ``(spark, sf_dir) -> DataFrame`` and oracle SQL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.fixtures import Fixtures
from . import clickstream as cs
from . import loyalty as ly
from . import subscriptions as sb
from . import retail as rt
from . import delivery as dl
from . import kept
from .derived import DerivedStore
from .oracle import clickstream as o_cs
from .oracle import loyalty as o_ly
from .oracle import subscriptions as o_sb
from .oracle import retail as o_rt
from .oracle import delivery as o_dl
from .oracle import kept as o_kept

#: Years whose weeks the yearly impact questions read by range.
SALES_YEARS = range(2005, 2025)

Query = Callable[[SparkSession, str], DataFrame]


def _fx(spark, sf_dir) -> Fixtures:
    return Fixtures(spark, sf_dir)


def _click() -> dict[str, Query]:
    def funnel(fx):
        return cs.product_funnel(fx.web_events, fx.page_hierarchy, fx.event_identifier)

    def summary(fx):
        return cs.campaign_summary(fx.web_events, fx.users, fx.page_hierarchy,
                                   fx.event_identifier, fx.campaigns)

    q = {
        "web_users": lambda fx: cs.distinct_users(fx.users),
        "web_cookies_per_user": lambda fx: cs.cookies_per_user(fx.users),
        "web_visits_by_month": lambda fx: cs.visits_by_month(fx.web_events),
        "web_events_by_type": lambda fx: cs.events_by_type(fx.web_events, fx.event_identifier),
        "web_purchase_visit_pct": lambda fx: cs.purchase_visit_pct(fx.web_events),
        "web_checkout_abandon_all": lambda fx: cs.checkout_abandonment(fx.web_events, "all"),
        "web_checkout_abandon_checkout":
            lambda fx: cs.checkout_abandonment(fx.web_events, "checkout"),
        "web_top_pages": lambda fx: cs.top_pages_by_views(fx.web_events, fx.page_hierarchy),
        "web_category_views_carts":
            lambda fx: cs.category_views_carts(fx.web_events, fx.page_hierarchy),
        "web_top_purchased": lambda fx: cs.top_purchased(fx.web_events, fx.page_hierarchy),
        "product_funnel": funnel,
        "category_funnel": lambda fx: cs.category_funnel(funnel(fx)),
        "funnel_leaders": lambda fx: cs.funnel_leaders(funnel(fx)),
        "funnel_most_abandoned": lambda fx: cs.funnel_top_rate(
            funnel(fx), "abandoned_count", "added_to_cart", "abandonment_rate"),
        "funnel_best_view_to_purchase": lambda fx: cs.funnel_top_rate(
            funnel(fx), "purchased_product", "product_views", "view_to_purchase_percentage"),
        "funnel_view_to_cart": lambda fx: cs.funnel_mean_rate(
            funnel(fx), "added_to_cart", "product_views", "view_to_cart_rate"),
        "funnel_cart_to_purchase": lambda fx: cs.funnel_mean_rate(
            funnel(fx), "purchased_product", "added_to_cart", "cart_to_purchase_rate"),
        "campaign_summary": summary,
        "campaign_impression_impact": lambda fx: cs.impression_impact(summary(fx)),
        "campaign_interaction_purchase": lambda fx: cs.interaction_purchase(summary(fx)),
        "campaign_scorecard": lambda fx: cs.campaign_scorecard(summary(fx)),
    }
    return q


def _loyalty() -> dict[str, Query]:
    return {
        "loyalty_total_spend": lambda fx: ly.total_spend(fx.sales, fx.menu),
        "loyalty_visit_days": lambda fx: ly.visit_days(fx.sales),
        "loyalty_first_items": lambda fx: ly.first_items(fx.sales, fx.menu),
        "loyalty_top_item": lambda fx: ly.top_item(fx.sales, fx.menu),
        "loyalty_favourite_per_customer": lambda fx: ly.favourite_per_customer(fx.sales, fx.menu),
        "loyalty_first_after_join": lambda fx: ly.first_after_join(fx.sales, fx.menu, fx.members),
        "loyalty_last_before_join": lambda fx: ly.last_before_join(fx.sales, fx.menu, fx.members),
        "loyalty_spend_before_join":
            lambda fx: ly.spend_before_join(fx.sales, fx.menu, fx.members),
        "loyalty_points": lambda fx: ly.points(fx.sales, fx.menu),
        "loyalty_points_first_week":
            lambda fx: ly.points_first_week(fx.sales, fx.menu, fx.members),
        "loyalty_joined_view": lambda fx: ly.joined_view(fx.sales, fx.menu, fx.members),
        "loyalty_runner_up_item": lambda fx: ly.top_item(fx.sales, fx.menu, place=2),
        "loyalty_view_summary": lambda fx: ly.view_summary(fx.sales, fx.menu, fx.members),
        "loyalty_member_ranking": lambda fx: ly.member_ranking(fx.sales, fx.menu, fx.members),
    }


def _subscriptions() -> dict[str, Query]:
    return {
        "subs_journey": lambda fx: sb.journey(fx.subscriptions, fx.plans),
        "subs_customers": lambda fx: sb.distinct_customers(fx.subscriptions),
        "subs_trials_by_month": lambda fx: sb.trials_by_month(fx.subscriptions),
        "subs_events_after": lambda fx: sb.events_after(fx.subscriptions, fx.plans),
        "subs_churn_rate": lambda fx: sb.churn_rate(fx.subscriptions),
        "subs_immediate_churn": lambda fx: sb.immediate_churn(fx.subscriptions),
        "subs_first_paid_plan": lambda fx: sb.first_paid_plan(fx.subscriptions, fx.plans),
        "subs_snapshot": lambda fx: sb.snapshot(fx.subscriptions, fx.plans),
        "subs_annual_upgrades": lambda fx: sb.annual_upgrades(fx.subscriptions),
        "subs_days_to_annual": lambda fx: sb.days_to_annual(fx.subscriptions),
        "subs_days_to_annual_bins": lambda fx: sb.days_to_annual_bins(fx.subscriptions),
        "subs_downgrades": lambda fx: sb.downgrades(fx.subscriptions),
        "subs_payments": lambda fx: sb.payments(fx.subscriptions, fx.plans),
        "subs_revenue_growth":
            lambda fx: sb.revenue_growth(sb.payments(fx.subscriptions, fx.plans)),
    }


def _retail() -> dict[str, Query]:
    def clean(fx):
        return rt.clean_weekly_sales(fx.weekly_sales_raw)

    def dated(fx, dates, outside=None):
        return rt.clean_weekly_sales(fx.weekly_sales(dates, outside))

    def yearly(fx, weeks):
        # ranges for the years of SALES_YEARS; sales of any other year are all read
        first, last = SALES_YEARS[0], SALES_YEARS[-1] + 1
        return dated(fx, rt.week_dates(weeks, SALES_YEARS), (dt.date(first, 1, 1), dt.date(last, 1, 1)))

    return {
        "clean_weekly_sales": clean,
        "retail_weekdays": lambda fx: rt.weekdays(clean(fx)),
        "retail_missing_weeks": lambda fx: rt.missing_weeks(fx.spark, clean(fx)),
        "retail_missing_weeks_by_year": lambda fx: rt.missing_weeks_by_year(clean(fx)),
        "retail_transactions_by_year": lambda fx: rt.transactions_by_year(clean(fx)),
        "retail_sales_region_month": lambda fx: rt.sales_region_month(clean(fx)),
        "retail_rows_by_platform": lambda fx: rt.rows_by_platform(clean(fx)),
        "retail_platform_share_month": lambda fx: rt.platform_share_month(clean(fx)),
        "retail_demographic_share_year": lambda fx: rt.demographic_share_year(clean(fx)),
        "retail_top_segments": lambda fx: rt.top_segments(clean(fx)),
        "retail_true_average": lambda fx: rt.true_average(clean(fx)),
        "impact_4w": lambda fx: rt.impact(dated(fx, rt.impact_dates(4)), 4),
        "impact_12w": lambda fx: rt.impact(dated(fx, rt.impact_dates(12)), 12),
        "impact_4w_by_year": lambda fx: rt.impact_by_year(yearly(fx, 4), 4),
        "impact_12w_by_year": lambda fx: rt.impact_by_year(yearly(fx, 12), 12),
        "impact_by_dimension": lambda fx: rt.impact_by_dimension(
            dated(fx, rt.week_dates(12, [rt.BREAKDOWN_YEAR]))),
    }


def _delivery() -> dict[str, Query]:
    def items(fx):
        return dl.clean_order_items(fx.order_items_raw)

    def runs(fx):
        return dl.clean_runs(fx.runs_raw)

    return {
        "clean_order_items": items,
        "clean_runs": runs,
        "delivery_item_count": lambda fx: dl.item_count(items(fx)),
        "delivery_order_count": lambda fx: dl.order_count(items(fx)),
        "delivery_success_per_runner": lambda fx: dl.success_per_runner(runs(fx)),
        "delivery_items_by_type": lambda fx: dl.items_by_type(items(fx), runs(fx)),
        "delivery_items_customer_type":
            lambda fx: dl.items_customer_type(items(fx), fx.item_types),
        "delivery_max_items_per_order": lambda fx: dl.max_items_per_order(items(fx), runs(fx)),
        "delivery_changed_vs_plain": lambda fx: dl.changed_vs_plain(items(fx), runs(fx)),
        "delivery_both_changes": lambda fx: dl.both_changes(items(fx), runs(fx)),
        "delivery_hour_histogram": lambda fx: dl.hour_histogram(items(fx)),
        "delivery_weekday_histogram": lambda fx: dl.weekday_histogram(items(fx)),
        "runner_signup_weeks": lambda fx: dl.signup_weeks(fx.runners),
        "runner_pickup_minutes": lambda fx: dl.pickup_minutes(items(fx), runs(fx)),
        "prep_time_by_size": lambda fx: dl.prep_time_by_size(items(fx), runs(fx)),
        "customer_mean_distance": lambda fx: dl.customer_mean_distance(items(fx), runs(fx)),
        "delivery_duration_spread": lambda fx: dl.duration_spread(runs(fx)),
        "runner_speed": lambda fx: dl.runner_speed(runs(fx)),
        "runner_success_pct": lambda fx: dl.success_pct(runs(fx)),
        "recipe_ingredients": lambda fx: dl.recipe_ingredients(
            fx.recipes, fx.item_types, fx.toppings, items(fx)),
        "top_extra_with_ties": lambda fx: dl.top_extra(items(fx), runs(fx), fx.toppings),
        "top_exclusion_with_ties": lambda fx: dl.top_exclusion(items(fx), runs(fx), fx.toppings),
        "order_item_label": lambda fx: dl.item_label(items(fx), fx.item_types, fx.toppings),
        "order_ingredient_list": lambda fx: dl.ingredient_list(
            items(fx), fx.item_types, fx.recipes, fx.toppings),
        "ingredient_totals": lambda fx: dl.ingredient_totals(
            items(fx), runs(fx), fx.recipes, fx.toppings),
        "revenue_base": lambda fx: dl.revenue_base(items(fx), runs(fx)),
        "revenue_with_extras": lambda fx: dl.revenue_with_extras(items(fx), runs(fx)),
        "ratings_contract": lambda fx: dl.ratings_contract(
            fx.ratings, runs(fx), fx.runners, items(fx)),
        "delivery_report": lambda fx: dl.delivery_report(fx.ratings, runs(fx), items(fx)),
        "net_profit": lambda fx: dl.net_profit(items(fx), runs(fx)),
    }


def _stored() -> dict[str, Query]:
    """Questions on derived tables that are stored in versions (built when they are not fresh)."""
    def on(name, ask):
        return lambda spark, sf_dir: ask(DerivedStore(spark, sf_dir).open(name))

    def in_2020(weeks, ask):
        first, last = rt.BASELINE_WEEK - weeks, rt.BASELINE_WEEK + weeks - 1
        year = rt.BASELINE.year
        return lambda clean: ask(clean.where((F.col("calendar_year") == year) & F.col("week_number").between(first, last)))

    weekly, funnel = "clean_weekly_sales", "product_funnel"
    return {
        "stored_impact_4w": on(weekly, in_2020(4, lambda c: rt.impact(c, 4))),
        "stored_impact_12w": on(weekly, in_2020(12, lambda c: rt.impact(c, 12))),
        "stored_impact_4w_by_year": on(weekly, lambda c: rt.impact_by_year(c, 4)),
        "stored_impact_12w_by_year": on(weekly, lambda c: rt.impact_by_year(c, 12)),
        "stored_impact_by_dimension": on(weekly, rt.impact_by_dimension),
        "stored_category_funnel": on(funnel, cs.category_funnel),
        "stored_funnel_leaders": on(funnel, cs.funnel_leaders),
        "stored_campaign_scorecard": on("campaign_summary", cs.campaign_scorecard),
        "stored_subs_revenue_growth": on("payments", sb.revenue_growth),
    }


def _wrap(builders: dict) -> dict[str, Query]:
    return {k: (lambda spark, sf_dir, _b=b: _b(_fx(spark, sf_dir))) for k, b in builders.items()}


QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

for _builders, _oracle in [(_click(), o_cs.ORACLE), (_loyalty(), o_ly.ORACLE),
                          (_subscriptions(), o_sb.ORACLE),
                          (_retail(), o_rt.ORACLE),
                          (_delivery(), o_dl.ORACLE)]:
    QUERIES.update(_wrap(_builders))
    ORACLE.update(_oracle)

#: Questions that a stored table answers as the plan over the base tables does.
STORED = _stored()
QUERIES.update(STORED)
ORACLE.update({k: ORACLE[k.removeprefix("stored_")] for k in STORED})

#: Tables that are kept current, loads and logs: these write to the shared folder.
KEPT = kept.QUERIES
QUERIES.update(KEPT)
ORACLE.update({k: ORACLE[o_kept.SAME[k]] if k in o_kept.SAME else o_kept.ORACLE[k] for k in KEPT})
