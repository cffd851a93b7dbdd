"""Materialised derived tables give the same answers as the on-the-fly plans,
and the retail table prunes partitions."""

import tempfile

from conftest import SMALL_SF
from ledgerlens.plans import clickstream as cs
from ledgerlens.plans import retail as rt
from ledgerlens.plans.catalog import QUERIES
from ledgerlens.plans.derived import build_derived_tables, open_derived_tables


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_derived_tables_round_trip(spark):
    out = tempfile.mkdtemp(prefix="ll-derived-")
    build_derived_tables(spark, SMALL_SF, out)
    t = open_derived_tables(spark, out)
    assert same(rt.impact_by_year(t["clean_weekly_sales"], 4),
                QUERIES["impact_4w_by_year"](spark, SMALL_SF))
    assert same(cs.campaign_scorecard(t["campaign_summary"]),
                QUERIES["campaign_scorecard"](spark, SMALL_SF))
    assert same(cs.category_funnel(t["product_funnel"]), QUERIES["category_funnel"](spark, SMALL_SF))
    plan = rt.impact_by_year(t["clean_weekly_sales"], 4)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters: [isnotnull(week_number" in plan
