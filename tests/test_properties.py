"""Invariants that must hold on any data and plan shape (item 5)."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SMALL_SF
from ledgerlens.operators.ranking import dense_rank_by_value, top_per_group
from ledgerlens.plans import clickstream as cs
from ledgerlens.plans import delivery as dl
from ledgerlens.plans import retail as rt
from ledgerlens.plans import subscriptions as sb
from ledgerlens.plans.catalog import KEPT, QUERIES, STORED
from ledgerlens.sources.fixtures import Fixtures


@pytest.fixture(scope="module")
def fx(spark):
    return Fixtures(spark, SMALL_SF)


def test_grouping_set_totals_equal_overall_total(fx):
    clean = rt.clean_weekly_sales(fx.weekly_sales_raw)
    by_dim = rt.impact_by_dimension(clean).collect()
    scoped = clean.where(F.col("week_number").between(12, 35) & (F.col("calendar_year") == 2020))
    total = scoped.agg(F.sum(F.when(F.col("week_number") <= 23, F.col("sales"))).alias("b"),
                       F.sum(F.when(F.col("week_number") >= 24, F.col("sales"))).alias("a")).collect()[0]
    for d in rt.DIMENSIONS:
        rows = [r for r in by_dim if r[d] != "-"]
        assert sum(r["before_sales"] or 0 for r in rows) == (total["b"] or 0)
        assert sum(r["after_sales"] or 0 for r in rows) == (total["a"] or 0)


def test_funnel_invariants(fx):
    funnel = cs.product_funnel(fx.web_events, fx.page_hierarchy, fx.event_identifier)
    rows = funnel.collect()
    assert rows
    for r in rows:
        assert r["added_to_cart"] >= r["purchased_product"] >= 0
        assert r["abandoned_count"] == r["added_to_cart"] - r["purchased_product"]
    cat = {r["product_category"]: r for r in cs.category_funnel(funnel).collect()}
    assert sum(r["category_views"] for r in cat.values()) == sum(r["product_views"] for r in rows)


def test_schedule_equals_a_plain_walk(fx):
    """Bills of each change, walked month by month in Python."""
    import calendar
    import datetime as dt

    def next_month(d):
        y, m = (d.year, d.month + 1) if d.month < 12 else (d.year + 1, 1)
        return dt.date(y, m, min(d.day, calendar.monthrange(y, m)[1]))

    horizon, timeline = dt.date(2021, 1, 1), {}
    for r in fx.subscriptions.collect():
        if r["plan_id"] != 0 and r["start_date"] < horizon:
            timeline.setdefault(r["customer_id"], []).append((r["start_date"], r["plan_id"]))
    want = []
    for customer, changes in timeline.items():
        changes.sort()
        for i, (start, plan) in enumerate(changes):
            end = changes[i + 1][0] if i + 1 < len(changes) else None
            bill = start
            while plan != 4:
                if bill != end:
                    want.append((customer, plan, bill))
                bill = next_month(bill)
                if plan == 3 or bill > (end or horizon):
                    break
    got = sb.payments(fx.subscriptions, fx.plans).select("customer_id", "plan_id", "start_date").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_cleaning_is_idempotent(fx):
    once = dl.clean_order_items(fx.order_items_raw)
    twice = dl.clean_order_items(once)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_skew_safe_dense_rank_matches_window(spark):
    # One key holds a third of all rows.
    hot = spark.range(0, 3000).select(F.lit(0).alias("k"), (F.col("id") % 97).alias("d"))
    cold = spark.range(0, 6000).select((F.col("id") % 50 + 1).alias("k"), (F.col("id") % 13).alias("d"))
    df = hot.unionByName(cold)
    want = df.withColumn("r", F.dense_rank().over(Window.partitionBy("k").orderBy("d")))
    got = dense_rank_by_value(df, ["k"], "d", "r")
    assert want.exceptAll(got.select("k", "d", "r")).count() == 0
    assert got.select("k", "d", "r").exceptAll(want).count() == 0
    top = top_per_group(df, ["k"], [F.desc("d")])
    assert top.where("k = 0").select("d").distinct().collect()[0]["d"] == 96


SINGLE = "Exchange SinglePartition"
AGG = re.compile(r"(HashAggregate|SortAggregate|ObjectHashAggregate|TakeOrderedAndProject|"
                 r"LocalTableScan|CollectLimit|GlobalLimit|LocalLimit)")


def _single_partition_inputs_are_aggregated(plan: str) -> bool:
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if SINGLE not in line:
            continue
        indent = len(line) - len(line.lstrip(" :+-"))
        for below in lines[i + 1:]:
            depth = len(below) - len(below.lstrip(" :+-"))
            if depth <= indent:
                break
            if AGG.search(below):
                break
            if "FileScan" in below or "Scan parquet" in below:
                return False
    return True


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_single_partition_step_over_raw_rows(spark, key):
    plan = QUERIES[key](spark, SMALL_SF)._jdf.queryExecution().executedPlan().toString()
    assert _single_partition_inputs_are_aggregated(plan), plan


def test_plan_check_flags_a_global_window_over_raw_rows(fx):
    bad = fx.web_events.withColumn("r", F.row_number().over(Window.orderBy("event_time")))
    plan = bad._jdf.queryExecution().executedPlan().toString()
    assert not _single_partition_inputs_are_aggregated(plan)


def _hot(spark):
    """A third of the rows belong to key 0; several rows share a day."""
    hot = spark.range(0, 4000).select(F.lit(0).alias("k"), "id", (F.col("id") * 7 % 11).alias("v"))
    cold = spark.range(0, 8000).select((F.col("id") % 40 + 1).alias("k"), "id", (F.col("id") % 5).alias("v"))
    return hot.unionByName(cold).withColumn(
        "d", F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 3 % 900).cast("int")))


def test_sequence_columns_match_windows_on_a_hot_key(spark):
    from ledgerlens.operators.sequences import sequence_columns
    df = _hot(spark)
    w = Window.partitionBy("k").orderBy("d", "id")
    want = df.select("k", "d", "id", "v", F.lag("v").over(w).alias("pv"), F.lead("d").over(w).alias("nd"),
                     F.row_number().over(w).cast("bigint").alias("rn"),
                     F.rank().over(Window.partitionBy("k").orderBy("d")).cast("bigint").alias("rk"))
    got = sequence_columns(df, ["k"], ["d", "id"], lags={"pv": "v"}, leads={"nd": "d"}, row_number="rn", rank="rk")
    got = got.select(*want.columns)
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0


def test_equal_rows_and_nulls_in_sequences(spark):
    """A key with most rows on one day, in few different rows; NULL keys, dates and values."""
    from ledgerlens.operators.sequences import sequence_columns
    day = "CAST('2020-05-05' AS DATE)"
    df = spark.range(3000).selectExpr("CAST(7 AS INT) AS k", f"{day} AS d", "CAST(id % 3 AS INT) AS v")
    df = df.unionByName(spark.sql(f"""SELECT * FROM VALUES (7, {day} - 1, 5), (7, {day} + 40, 1), (NULL, {day}, 2),
        (NULL, {day}, NULL), (NULL, NULL, 4), (8, NULL, 1), (8, NULL, 1), (8, {day}, 9) AS t(k, d, v)"""))
    w = Window.partitionBy("k").orderBy("d", "v")
    want = df.select("k", "d", "v", F.lag("v").over(w).alias("pv"), F.lead("d").over(w).alias("nd"),
                     F.row_number().over(w).cast("bigint").alias("rn"),
                     F.rank().over(Window.partitionBy("k").orderBy("d")).cast("bigint").alias("rk"))
    got = sequence_columns(df, ["k"], ["d", "v"], lags={"pv": "v"}, leads={"nd": "d"}, row_number="rn", rank="rk")
    got = got.select(*want.columns)
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0


def test_a_hot_day_takes_no_task_over_a_tenth(spark):
    """Rows that leave the shuffle by key and period, when a third of all rows are one customer's on
    one day."""
    from ledgerlens.operators.sequences import sequence_columns
    hot = spark.range(60_000).selectExpr("CAST(1 AS INT) AS k", "CAST('2020-05-05' AS DATE) AS d", "CAST(id % 4 AS INT) AS v")
    cold = spark.range(120_000).selectExpr("CAST(2 + id % 5000 AS INT) AS k",
                                           "DATE_ADD(CAST('2020-01-01' AS DATE), CAST(id % 365 AS INT)) AS d",
                                           "CAST(id % 4 AS INT) AS v")
    df = hot.unionByName(cold)
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    biggest = counted.groupBy("k", "d").count().agg(F.max("count")).first()[0]
    assert biggest * 10 < counted.count()
    out = sequence_columns(df, ["k"], ["d", "v"], row_number="rn")
    assert out.where("k = 1").agg(F.max("rn")).first()[0] == 60_000


def test_payments_read_orders_once_per_timeline(spark):
    df = QUERIES["subs_payments"](spark, SMALL_SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    assert plan.count("ReusedExchange") >= 1, plan
    assert len(re.findall(r"Scan parquet", plan)) <= 4, plan


def test_asof_and_snapshot_match_windows_on_a_hot_key(spark):
    import datetime as dt
    from ledgerlens.operators.asof import asof_first, asof_last, snapshot_at
    df = _hot(spark).select("k", "d", "v", "id")
    anchors = spark.range(0, 30).select(F.col("id").cast("int").alias("k"), F.lit(dt.date(2020, 6, 1)).alias("a"))
    j = df.join(anchors, "k")
    for got, side, order in ((asof_first(df, anchors, "k", "d", "a"), j.where("d >= a"), F.asc("d")),
                             (asof_last(df, anchors, "k", "d", "a"), j.where("d < a"), F.desc("d"))):
        want = side.withColumn("r", F.rank().over(Window.partitionBy("k").orderBy(order))).where("r = 1").drop("r")
        cols = ["k", "d", "v", "id", "a"]
        assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    before = dt.date(2020, 9, 1)
    w = Window.partitionBy("k").orderBy(F.desc("d"), "v", "id")
    want = df.where(F.col("d") < F.lit(before)).withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")
    got = snapshot_at(df, "k", "d", before, ["v", "id"])
    assert sorted(map(tuple, got.select("k", "d", "v", "id").collect())) == sorted(
        map(tuple, want.select("k", "d", "v", "id").collect()))


HOT_KEYS = ["loyalty_first_after_join", "loyalty_last_before_join", "subs_snapshot", "subs_first_paid_plan",
            "subs_immediate_churn", "subs_payments"]


@pytest.mark.parametrize("key", HOT_KEYS)
def test_no_window_holds_a_whole_customer(spark, key):
    plan = QUERIES[key](spark, SMALL_SF)._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window [" in line and "customer_id" in line:
            # one row per customer and period, or windows inside a period
            assert "__period" in line, line


def test_impact_keys_push_ship_dates(spark):
    for key in ("impact_4w", "impact_12w", "impact_4w_by_year", "impact_12w_by_year", "impact_by_dimension"):
        plan = QUERIES[key](spark, SMALL_SF)._jdf.queryExecution().executedPlan().toString()
        pushed = [m for m in re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan, re.S) if "l_shipdate" in m]
        assert pushed and "GreaterThanOrEqual(l_shipdate" in pushed[0], plan


@pytest.mark.parametrize("key,reads", [("order_item_label", 2), ("order_ingredient_list", 3), ("ingredient_totals", 1),
                                       ("retail_missing_weeks_by_year", 1), ("ratings_contract", 1)])
def test_line_items_are_read_few_times(spark, key, reads):
    """Scans that run; what stands under a reused exchange is not run again."""
    df = QUERIES[key](spark, SMALL_SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert 1 <= len(re.findall(r"FileScan parquet \[l_orderkey", plan)) <= reads, plan


def test_the_contract_reads_orders_once_per_table(spark):
    plan = QUERIES["ratings_contract"](spark, SMALL_SF)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[.*o_orderkey", plan)) <= 4, plan


def test_no_job_runs_while_a_plan_is_built(spark, monkeypatch):
    """Only file footers are read for their schema; no key asks for rows, but for those that keep
    a stored table current before they read it."""
    def refuse(*_, **__):
        raise AssertionError("an action while the plan is built")

    for name in ("collect", "first", "head", "take", "count", "toPandas", "checkpoint", "localCheckpoint",
                 "isEmpty", "cache", "persist"):
        monkeypatch.setattr(type(spark.range(0)), name, refuse)
    for key in set(QUERIES) - set(STORED) - set(KEPT):
        QUERIES[key](spark, SMALL_SF)
