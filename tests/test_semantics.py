"""Cases that the generated data never holds: two cookies in a visit, two runs of an order, sums
beyond a bigint, several changes on one day, and loads that break their contract."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import functions as LF
from ledgerlens.plans import clickstream as cs
from ledgerlens.plans import delivery as dl
from ledgerlens.plans import loyalty as ly
from ledgerlens.plans import subscriptions as sb
from ledgerlens.plans.retail import missing_weeks_by_year
from ledgerlens.sources.fixtures import Fixtures
from ledgerlens.sources.sinks import load_checked
from seeds import frames


@pytest.fixture(scope="module")
def dims(spark):
    return Fixtures(spark, "/nonexistent")


def test_visit_with_two_cookies_of_one_user(spark, dims):
    t = dt.datetime(2024, 1, 2)
    events = spark.createDataFrame(
        [("v", "c1", 3, 2, 1, t), ("v", "c2", 4, 2, 2, t + dt.timedelta(minutes=1)), ("v", "c1", 5, 2, 3, t),
         ("v", "c2", 5, 3, 4, t + dt.timedelta(hours=1))],
        "visit_id string, cookie_id string, page_id int, event_type int, event_id int, event_time timestamp_ntz")
    users = spark.createDataFrame([(1, "c1"), (1, "c2")], "user_id int, cookie_id string")
    (r,) = cs.campaign_summary(events, users, dims.page_hierarchy, dims.event_identifier, dims.campaigns).collect()
    assert (r["user_id"], r["visit_id"], r["cart_adds"], r["purchase"]) == (1, "v", 3, 1)
    assert r["cart_products"] == "Salmon, Tuna, Kingfish" and r["campaign_name"].startswith("BOGOF")


def test_two_runs_of_one_order_are_summed(spark):
    runs = spark.createDataFrame([(1, 7, "20km", "60", None), (1, 7, "10km", "60", None), (2, 7, "30", "30", "")],
                                 "order_id int, runner_id int, distance string, duration string, cancellation string") \
        .withColumn("pickup_time", F.lit("2020-01-01 00:00:00"))
    got = {r["order_id"]: r["avg_speed_kmph"] for r in dl.runner_speed(dl.clean_runs(runs)).collect()}
    assert got == {1: Decimal("30.0"), 2: Decimal("60.0")}


def test_lift_of_huge_campaigns(spark):
    n = 4_000_000_000
    summary = spark.createDataFrame([("c", 1, n, n // 2), ("c", 0, n, n // 4)],
                                    "campaign_name string, impression long, rows long, purchase long")
    # rows stand for that many visits: weigh the sums instead of making them
    p1, n1, p0, n0 = (F.sum(F.when(F.col("impression") == i, F.col(c)).otherwise(0)).cast("decimal(19,0)")
                      for i, c in ((1, "purchase"), (1, "rows"), (0, "purchase"), (0, "rows")))
    lift = summary.agg(LF.ratio(p1 * n0 - p0 * n1, n1 * p0, 2, 100).alias("x")).first()["x"]
    assert lift == Decimal("100.00")


def test_ratio_beyond_a_bigint(spark):
    one = spark.range(1)
    big = one.select(LF.ratio(F.lit(9 * 10**17), F.lit(1), 2, 100, precision=38).alias("x")).first()["x"]
    assert big == Decimal(9 * 10**19)
    assert one.select(LF.ratio(F.lit(-10**18), F.lit(3), 2, 1, precision=38).alias("x")).first()["x"] == \
        Decimal("-333333333333333333.33")


def test_two_changes_on_one_day(spark, dims):
    d = dt.date
    subs = spark.createDataFrame([(1, 0, d(2020, 1, 1)), (1, 1, d(2020, 3, 10)), (1, 2, d(2020, 3, 10)),
                                  (1, 3, d(2020, 5, 1)), (1, 3, d(2020, 5, 1))],
                                 "customer_id int, plan_id int, start_date date")
    got = sorted((r["start_date"], r["plan_id"], r["payment_order"], r["amount_paid"])
                 for r in sb.payments(subs, dims.plans).collect())
    pro, annual = Decimal("19.90"), Decimal("199.00")
    assert got == [(d(2020, 3, 10), 2, 1, pro), (d(2020, 4, 10), 2, 2, pro), (d(2020, 5, 1), 3, 3, annual)]


def test_downgrades_are_one_row_per_basic_change(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(300)]
    subs = spark.createDataFrame([(1, 2 if i % 2 == 0 else 1, x) for i, x in enumerate(days)],
                                 "customer_id int, plan_id int, start_date date")
    rows = sb.downgrades(subs).collect()
    assert len(rows) == 150 and {r["pro_start"] for r in rows} == {days[0]}


def test_load_splits_accepted_and_rejected(spark, tmp_path):
    schema = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("runner_id", T.IntegerType()),
                           T.StructField("customer_id", T.LongType()), T.StructField("rating", T.IntegerType()),
                           T.StructField("rating_time", T.TimestampNTZType())])
    runs = spark.createDataFrame([(i,) for i in range(1, 9)], "order_id int")
    t = dt.datetime(2021, 1, 1)

    def load(rows):
        df = spark.createDataFrame(rows, "order_id int, runner_id int, customer_id int, rating int, rating_time timestamp_ntz")
        return load_checked(df, str(tmp_path / "ratings"), str(tmp_path / "rejected"), schema, dl.rating_rules(),
                            ["order_id"], {"order_id": (runs, "order_id")}, ("rating_time",))

    good, bad = load([(1, 1, 1, 5, t), (2, 1, 1, 9, t), (3, None, 1, 2, t), (4, 1, 1, None, None), (5, 1, 1, 1, t),
                      (5, 1, 1, 2, t), (99, 1, 1, 3, t)])
    assert sorted(r["order_id"] for r in good.collect()) == [1, 4]
    assert sorted((r["order_id"], r["broken"]) for r in bad.collect()) == [
        (2, ["rating_1_to_5"]), (3, ["not_null"]), (5, ["pk"]), (5, ["pk"]), (99, ["fk_order_id"])]
    assert good.where("rating_time IS NULL").count() == 0
    load([(1, 1, 1, 4, t), (6, 1, 1, 4, t)])
    kept = spark.read.parquet(str(tmp_path / "ratings"))
    assert sorted(r["order_id"] for r in kept.collect()) == [1, 4, 6] and kept.schema == schema
    assert spark.read.parquet(str(tmp_path / "rejected")).count() == 6


def test_named_view_is_read_by_a_second_statement(spark):
    f = frames(spark)
    ly.view_summary(f["sales"], f["menu"], f["members"], name="purchases_test").collect()
    rows = spark.sql("SELECT customer_id, count(*) AS n FROM purchases_test WHERE member = 'Y' GROUP BY 1").collect()
    assert {(r[0], r[1]) for r in rows} == {("A", 4), ("B", 3)}


def test_missing_weeks_by_region_and_year(spark):
    clean = spark.createDataFrame([("x", 2020, w) for w in range(2, 53) if w != 30] + [("y", 2021, 1)],
                                  "region string, calendar_year int, week_number int")
    got = {(r["region"], r["calendar_year"], r["missing_week_number"]) for r in missing_weeks_by_year(clean).collect()}
    assert got == {("x", 2020, 1), ("x", 2020, 30)} | {("y", 2021, w) for w in range(2, 53)}
