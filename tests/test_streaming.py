"""Streaming forms agree with the batch pipelines on closed visits."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SMALL_SF
from ledgerlens.plans import clickstream as cs
from ledgerlens.plans import delivery as dl
from ledgerlens.sources.fixtures import Fixtures
from ledgerlens.plans.catalog import QUERIES
from ledgerlens.sources.versions import VersionedTable
from ledgerlens.streaming import (arrivals, clean_on_arrival, event_stream, funnel_refresh, monthly_visitors,
                                  read_funnel, read_weekly_sales, settle_weekly_sales, user_days_refresh,
                                  visit_summary_stream, weekly_sales_refresh, with_users, write_closed_visits)


def test_visit_summary_stream_matches_batch_for_closed_visits(spark):
    fx = Fixtures(spark, SMALL_SF)
    work = tempfile.mkdtemp(prefix="ll-stream-")
    src = os.path.join(work, "events")
    raw = spark.read.parquet(os.path.join(SMALL_SF, "events.parquet"))
    # Arrive in three files by day ranges.
    day = F.dayofmonth("ts")
    for lo, hi in [(1, 10), (11, 20), (21, 31)]:
        raw.where((day >= lo) & (day <= hi)).write.mode("append").parquet(src)
    stream = visit_summary_stream(event_stream(spark, src, max_files=1),
                                  fx.page_hierarchy, fx.campaigns)
    q = (stream.writeStream.format("memory").queryName("visit_summary_stream")
         .outputMode("append").option("checkpointLocation", os.path.join(work, "ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = with_users(spark.table("visit_summary_stream"), fx.users)
    batch = cs.campaign_summary(fx.web_events, fx.users, fx.page_hierarchy,
                                fx.event_identifier, fx.campaigns)
    closed = batch.join(got.select("visit_id"), "visit_id", "left_semi")
    assert got.count() > 0
    cols = ["user_id", "visit_id", "visit_start_time", "page_views", "cart_adds", "purchase",
            "campaign_name", "impression", "click", "cart_products"]
    assert sorted(map(tuple, got.select(cols).collect()), key=str) == \
        sorted(map(tuple, closed.select(cols).collect()), key=str)
    # Visits not emitted yet are exactly those of the last day (still open).
    last_day = batch.agg(F.max(F.to_date("visit_start_time"))).collect()[0][0]
    open_days = {r[0] for r in batch.join(got, "visit_id", "left_anti")
                 .select(F.to_date("visit_start_time")).distinct().collect()}
    assert open_days <= {last_day}


def test_clean_on_arrival_equals_batch(spark):
    fx = Fixtures(spark, SMALL_SF)
    work = tempfile.mkdtemp(prefix="ll-clean-")
    src = os.path.join(work, "runs")
    raw = fx.runs_raw
    raw.write.parquet(src)
    stream = clean_on_arrival(spark.readStream.schema(raw.schema).parquet(src), dl.clean_runs)
    q = (stream.writeStream.format("memory").queryName("clean_runs_stream")
         .option("checkpointLocation", os.path.join(work, "ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("clean_runs_stream")
    want = dl.clean_runs(raw)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_closed_visits_file_sink(spark):
    fx = Fixtures(spark, SMALL_SF)
    work = tempfile.mkdtemp(prefix="ll-sink-")
    src = os.path.join(work, "events")
    spark.read.parquet(os.path.join(SMALL_SF, "events.parquet")).write.parquet(src)
    stream = visit_summary_stream(event_stream(spark, src), fx.page_hierarchy, fx.campaigns)
    out = os.path.join(work, "visits")
    q = write_closed_visits(stream, out, os.path.join(work, "ckpt"))
    q.awaitTermination()
    written = spark.read.parquet(out)
    assert written.count() > 0
    assert written.select("visit_id").distinct().count() == written.count()


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


class _Arrivals:
    """Line items and orders that arrive in folders, and their weekly sales."""

    def __init__(self, spark):
        self.spark, self.fx, self.work = spark, Fixtures(spark, SMALL_SF), tempfile.mkdtemp(prefix="ll-weekly-")
        self.tables = {t: spark.read.parquet(os.path.join(SMALL_SF, f"{t}.parquet")) for t in ("lineitem", "orders")}
        self.out = os.path.join(self.work, "weekly")
        for t in self.tables:
            os.makedirs(os.path.join(self.work, t))

    def arrive(self, table, where, minute, rows=None):
        """Files of ``table`` that arrive ``minute`` minutes after the first ones."""
        folder = os.path.join(self.work, table)
        known = set(os.listdir(folder))
        (self.tables[table] if rows is None else rows).where(where).coalesce(1).write.mode("append").parquet(folder)
        for name in set(os.listdir(folder)) - known:
            os.utime(os.path.join(folder, name), (1.7e9 + 60 * minute,) * 2)

    def stream(self, table):
        return arrivals(self.spark, os.path.join(self.work, table), self.tables[table].schema)

    def held(self):
        return self.spark.read.schema(self.tables["orders"].schema).parquet(os.path.join(self.work, "orders"))

    def refresh(self, wait):
        weekly_sales_refresh(self.fx, self.stream("lineitem"), self.stream("orders"), self.out,
                             os.path.join(self.work, "ckpt"), self.held, wait).awaitTermination()


def test_weekly_sales_refresh_equals_batch(spark):
    """Lines before, with and after their orders meet in the state of the join."""
    a = _Arrivals(spark)
    for k in range(3):
        a.arrive("lineitem", f"l_orderkey % 3 = {k}", 5 * k)
        a.arrive("orders", f"o_orderkey % 3 = {(k + 1) % 3}", 5 * k)
        a.refresh("1 hour")
    assert settle_weekly_sales(a.fx, a.out, a.held) == 0
    assert _same(read_weekly_sales(spark, a.out), a.fx.weekly_sales_raw)
    some = read_weekly_sales(spark, a.out, weeks=(20, 27))
    assert "PartitionFilters: [isnotnull(week_number" in some._jdf.queryExecution().executedPlan().toString()
    # compacted: a week lies in one folder, however many batches touched it
    paths = VersionedTable(spark, a.out, ("calendar_year", "week_number")).current().paths
    assert len(paths) == len({p.split("/", 1)[1] for p in paths})


def test_lines_whose_orders_come_too_late_for_the_join(spark):
    """Orders that come an hour before or after their lines, with ten minutes to wait."""
    a = _Arrivals(spark)
    a.arrive("lineitem", "l_orderkey % 2 = 0", 0)
    a.arrive("orders", "o_orderkey % 2 = 1", 0)
    a.refresh("10 minutes")
    a.arrive("lineitem", "l_orderkey % 2 = 1", 60)
    a.arrive("orders", "o_orderkey % 2 = 0", 60)
    a.refresh("10 minutes")
    table = VersionedTable(spark, a.out, ("calendar_year", "week_number"))
    for minute in (120, 180):  # time goes on: rows of other orders
        for name, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
            a.arrive(name, "true", minute, a.tables[name].limit(1).withColumn(key, F.lit(-minute).cast("long")))
        a.refresh("10 minutes")
    settle_weekly_sales(a.fx, a.out, a.held)
    got = read_weekly_sales(spark, a.out).agg(F.sum("transactions")).first()[0]
    assert got == a.tables["lineitem"].count() + 2
    assert table.beside("waiting").count() == 0


def test_waiting_rows_are_not_held_in_a_state_store(spark):
    """a store of all lines and orders did not fit; what waits lies beside the table."""
    a = _Arrivals(spark)
    a.arrive("lineitem", "true", 0)
    a.arrive("orders", "o_orderkey % 2 = 0", 0)
    table = VersionedTable(spark, a.out, ("calendar_year", "week_number"))
    late = a.tables["lineitem"].where("l_orderkey % 2 = 1").count()
    for waiting in (late, 0):
        query = weekly_sales_refresh(a.fx, a.stream("lineitem"), a.stream("orders"), a.out,
                                     os.path.join(a.work, "ckpt"), a.held, "3650 days")
        query.awaitTermination()
        assert query.recentProgress and not any(p["stateOperators"] for p in query.recentProgress)
        assert not os.path.exists(os.path.join(a.work, "ckpt", "state"))
        assert table.beside("waiting").count() == waiting
        a.arrive("orders", "o_orderkey % 2 = 1", 5)
    assert _same(read_weekly_sales(spark, a.out), a.fx.weekly_sales_raw)


def test_orders_that_are_not_stored_yet_wait_beside_the_table(spark):
    """Orders come twice, before their lines, and are not among the held ones."""
    a = _Arrivals(spark)
    stored, a.held = a.held, lambda: stored().limit(0)
    table = VersionedTable(spark, a.out, ("calendar_year", "week_number"))

    def counted():
        return read_weekly_sales(spark, a.out).agg(F.sum("transactions")).first()[0]

    a.arrive("orders", "o_orderkey % 2 = 0", 0)
    a.arrive("orders", "o_orderkey % 2 = 0", 0)
    a.refresh("1 hour")
    a.arrive("lineitem", "l_orderkey % 4 = 0", 50)
    a.refresh("1 hour")
    quarter = a.tables["lineitem"].where("l_orderkey % 4 = 0").count()
    assert counted() == quarter and table.beside("waiting").count() == 0
    assert table.beside("orders").count() > 0
    # time goes on, on both sides: no line within an hour of the first orders can come
    a.arrive("orders", "o_orderkey = 1", 300)
    a.arrive("lineitem", "l_orderkey % 4 = 2", 300)
    a.refresh("1 hour")
    assert counted() == a.tables["lineitem"].where("l_orderkey % 2 = 0").count()
    assert [r["o_orderkey"] for r in table.beside("orders").collect()] == [1]
    a.held = stored
    a.arrive("lineitem", "l_orderkey % 2 = 1", 301)
    a.refresh("1 hour")
    assert table.beside("orders").count() == 0 and table.beside("waiting").count() > 0
    a.arrive("orders", "o_orderkey % 2 = 1", 900)
    a.refresh("1 hour")
    assert counted() == a.tables["lineitem"].count() and settle_weekly_sales(a.fx, a.out, a.held) == 0


def test_a_batch_that_runs_again_counts_once(spark):
    table = VersionedTable(spark, tempfile.mkdtemp(prefix="ll-again-"), ("day",))

    def together(rows):
        return rows.groupBy("k", "day").agg(F.sum("n").alias("n"))

    one = spark.createDataFrame([("a", 1, "d1"), ("b", 2, "d2")], "k string, n long, day string")
    two = spark.createDataFrame([("a", 5, "d1")], "k string, n long, day string")
    first = table.merge(one, together, ("s", 0))
    second = table.merge(two, together, ("s", 1))
    assert table.merge(two, together, ("s", 1)) == table.merge(one, together, ("s", 0)) == second
    assert sorted(map(tuple, table.read().select("k", "n", "day").collect())) == [("a", 6, "d1"), ("b", 2, "d2")]
    assert sorted(map(tuple, table.read(first).select("k", "n").collect())) == [("a", 1), ("b", 2)]
    untouched = [p for p in first.paths if p.endswith("day=d2")]
    assert untouched and set(untouched) <= set(second.paths)


def test_funnel_refresh_equals_batch(spark):
    fx, work = Fixtures(spark, SMALL_SF), tempfile.mkdtemp(prefix="ll-funnel-")
    src, out, ckpt = (os.path.join(work, d) for d in ("events", "parts", "ckpt"))
    raw = spark.read.parquet(os.path.join(SMALL_SF, "events.parquet"))
    for k in range(3):  # a visit's events arrive in different batches
        raw.where(F.col("event_id") % 3 == k).write.mode("append").parquet(src)
        funnel_refresh(event_stream(spark, src), out, ckpt).awaitTermination()
    funnel = read_funnel(spark, out, fx.page_hierarchy)
    assert _same(funnel, QUERIES["product_funnel"](spark, SMALL_SF))
    assert _same(cs.category_funnel(funnel), QUERIES["category_funnel"](spark, SMALL_SF))


def test_monthly_visitors_equal_distinct_counts(spark):
    work = tempfile.mkdtemp(prefix="ll-users-")
    src, out, ckpt = (os.path.join(work, d) for d in ("events", "days", "ckpt"))
    raw = spark.read.parquet(os.path.join(SMALL_SF, "events.parquet"))
    far = raw.where("event_id % 5 = 0").withColumn("user_id", F.col("user_id") * 40_000 + 2**40)
    raw = raw.unionByName(far)
    for k in range(3):
        raw.where(F.col("event_id") % 3 == k).write.mode("append").parquet(src)
        user_days_refresh(event_stream(spark, src), out, ckpt).awaitTermination()
    want = raw.groupBy(F.date_format("ts", "MMMM").alias("month")).agg(
        F.countDistinct("user_id", F.to_date("ts")).alias("visit_count"),
        F.countDistinct("user_id").alias("user_count"))
    assert _same(monthly_visitors(spark, out), want)
