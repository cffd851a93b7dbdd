"""Incremental forms of the batch pipelines (X1, X2, A3 to A5 kept current).

``visit_summary_stream`` maintains the per-visit campaign summary as events
arrive: a stateful streaming aggregation keyed by visit (user and day) and the
day's end, watermarked so a visit's state is finalised and dropped once its day closes;
append mode emits each closed visit exactly once. Cart products keep their
event order by carrying (event_time, event_id) and sorting at emission, which
is the same order the batch sequence number encodes. Visits carry their cookie; the user is looked
up when they are read (``with_users``), so a user who becomes known after the visit is not lost.

``weekly_sales_refresh`` joins arriving line items to arriving orders, in any order of arrival, and
merges their weekly sums into the weeks they touch; ``funnel_refresh`` and ``user_days_refresh``
merge visit pages and bitmaps of users into the days they touch. All three keep their table in
versions (:mod:`ledgerlens.sources.versions`): a touched partition is written anew in one folder, the
version is swapped by one log row, and the row names the micro-batch, so a batch that is run again
counts once and no parts pile up.

``clean_on_arrival`` applies the batch cleaning projections to a stream of
raw rows (map-only, no state).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import month_name, week_of_year_bucket
from ..operators.sizing import fixed_dimension
from ..plans.clickstream import funnel_of, visit_pages
from ..sources.fixtures import LINE_COLUMNS, ORDER_COLUMNS, WEEKLY_KEYS, Fixtures, shaped_events
from ..sources.versions import Version, VersionedTable

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def event_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Raw events arriving as Parquet files in ``folder``."""
    r = spark.readStream.schema(EVENT_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(folder)


def visit_summary_stream(raw_events: DataFrame, pages: DataFrame, campaigns: DataFrame,
                         lateness: str = "1 hour") -> DataFrame:
    """Summaries of closed visits, with their cookie (see :func:`with_users`)."""
    ev = shaped_events(raw_events).where(F.col("event_type").isNotNull())
    ev = ev.join(fixed_dimension(pages.select("page_id", "page_name")), "page_id", "left")
    et = F.col("event_type")

    def count_of(code):
        return F.sum(F.when(et == code, 1).otherwise(0)).cast("bigint")

    # A visit is a user's calendar day: key its state by the day's end so the
    # watermark (max day end seen minus ``lateness``) closes day D once events
    # from later days arrive.
    day_end = F.date_add(F.to_date("event_time"), 1).cast("timestamp")
    carted = F.when((et == 2) & F.col("page_name").isNotNull(),
                    F.struct("event_time", "event_id", "page_name"))
    per_visit = (ev.withColumn("day_end", day_end).withWatermark("day_end", lateness)
                 .groupBy("day_end", "visit_id", "cookie_id")
                 .agg(F.min("event_time").alias("visit_start_time"),
                      count_of(1).alias("page_views"), count_of(2).alias("cart_adds"),
                      F.max(F.when(et == 3, 1).otherwise(0)).alias("purchase"),
                      count_of(4).alias("impression"), count_of(5).alias("click"),
                      F.collect_list(carted).alias("carts")))
    ordered = F.transform(F.array_sort("carts"), lambda s: s["page_name"])
    cart_text = F.when(F.size("carts") > 0, F.array_join(ordered, ", "))
    summary = per_visit.select("visit_id", "cookie_id", "visit_start_time", "page_views",
                               "cart_adds", "purchase", "impression", "click",
                               cart_text.alias("cart_products"))
    cond = F.col("visit_start_time").between(F.col("start_date"), F.col("end_date"))
    matched = summary.join(fixed_dimension(campaigns.select("campaign_name", "start_date",
                                                            "end_date")), cond, "left")
    return matched.select("cookie_id", "visit_id", "visit_start_time", "page_views", "cart_adds",
                          "purchase", "campaign_name", "impression", "click", "cart_products")


def with_users(visits: DataFrame, users: DataFrame) -> DataFrame:
    """Stored visits with the user of their cookie, as known now."""
    return visits.join(users.select("cookie_id", "user_id"), "cookie_id").drop("cookie_id")


def write_closed_visits(summary_stream: DataFrame, path: str, checkpoint_location: str,
                        available_now: bool = True):
    """Append each closed visit once to a Parquet table partitioned by visit
    day. The checkpoint location (shared storage) makes the query restartable
    with exactly-once file output."""
    out = summary_stream.withColumn("visit_day", F.to_date("visit_start_time"))
    w = (out.writeStream.format("parquet").outputMode("append").partitionBy("visit_day")
         .option("path", path).option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def arrivals(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Rows arriving as Parquet files in ``folder``, with the time at which their file ``arrived``
    (the same again if a batch is repeated)."""
    return spark.readStream.schema(schema).parquet(folder) \
        .select("*", F.col("_metadata.file_modification_time").alias("arrived"))


def lines_with_orders(lines: DataFrame, orders: DataFrame,
                      places: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Line items, each with the columns of its order if that has come: an outer join on the order
    key. An order that comes twice joins once. ``places`` adds columns on the order side, so that
    the line items (the largest table) are shuffled once."""
    once = orders.where(F.col("o_orderkey").isNotNull()).dropDuplicates(["o_orderkey"])
    return lines.select(*LINE_COLUMNS).join(places(once) if places else once,
                                            F.col("l_orderkey") == F.col("o_orderkey"), "left")


def _both(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Two streams (:func:`arrivals`) as one: a micro-batch has what came on either side."""
    return lines.select(*LINE_COLUMNS, "arrived", F.lit(True).alias("is_line")).unionByName(
        orders.select(*ORDER_COLUMNS, "arrived", F.lit(False).alias("is_line")), allowMissingColumns=True)


def weekly_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, ("calendar_year", "week_number"))


def _not_held(table: VersionedTable, version: Version | None, batch: DataFrame, held: DataFrame) -> DataFrame:
    """Arrived orders that ``held`` lacks, now or since an earlier batch."""
    came, before = batch.where(~F.col("is_line")).select(*ORDER_COLUMNS, "arrived"), table.beside("orders", version)
    came = came if before is None else came.unionByName(before)
    return table.staged(came.where(F.col("o_orderkey").isNotNull())
                        .join(held.select("o_orderkey"), "o_orderkey", "left_anti"))


def _still_open(orders: DataFrame, batch: DataFrame, wait: str) -> DataFrame:
    """Orders for which a line at most ``wait`` from them can still come. The time is that of the
    side that is behind, less ``wait`` for rows that come late; without lines it stands still."""
    if orders.isEmpty():
        return orders
    is_line, arrived = F.col("is_line"), F.col("arrived")
    newest = batch.select("arrived", "is_line").unionByName(orders.select("arrived", F.lit(False).alias("is_line"))) \
        .agg(F.max(F.when(is_line, arrived)).alias("line"), F.max(F.when(~is_line, arrived)).alias("order"))
    oldest = F.least("line", "order") - F.expr(f"2 * INTERVAL {wait}")
    return orders.crossJoin(newest).where(F.col("line").isNull() | (arrived >= oldest)).select(*orders.columns)


def _add_lines(fixtures: Fixtures, table: VersionedTable, held_orders: Callable[[], DataFrame],
               batch: DataFrame | None = None, wait: str = "", load: tuple[str, int] | None = None) -> None:
    """Count the line items of a batch (:func:`_both`), if any, and those that were still waiting;
    what has no order, or no customer, goes on waiting. All of it is part of one version."""
    version = table.current()
    if version and load and version.applied.get(load[0], -1) >= load[1]:
        return
    held, late, beside = held_orders().select(*ORDER_COLUMNS), table.beside("waiting", version), {}
    lines, lacking = [] if late is None else [late], table.beside("orders", version)
    if batch is not None:
        lines.append(batch.where("is_line").select(*LINE_COLUMNS))
        lacking = _not_held(table, version, batch, held)
        beside["orders"] = _still_open(lacking, batch, wait)
    known = held if lacking is None else held.unionByName(lacking.select(*ORDER_COLUMNS))
    placed = table.staged(
        lines_with_orders(reduce(DataFrame.unionByName, lines), known, lambda o: fixtures.with_places(o, "left"))
        .select(*LINE_COLUMNS, "o_orderpriority", "c_mktsegment", "r_name"))
    whole = F.col("r_name").isNotNull()
    sums = fixtures.weekly_sums(placed.where(whole)).withColumns(
        {"calendar_year": F.year("wk"), "week_number": week_of_year_bucket(F.col("wk"))})
    beside["waiting"] = placed.where(~whole).select(*LINE_COLUMNS)
    table.merge(sums, _weeks_together, load, beside)


def _weeks_together(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*WEEKLY_KEYS, "calendar_year", "week_number").agg(
        F.sum("transactions").alias("transactions"), F.sum("sales").alias("sales"))


def weekly_sales_refresh(fixtures: Fixtures, lines: DataFrame, orders: DataFrame, path: str,
                         checkpoint_location: str, held_orders: Callable[[], DataFrame],
                         wait: str = "1 hour"):
    """Keep the weekly sales current from arriving line items and orders, in any order of arrival.

    Either side waits for the other in files beside the table, not in the memory of a state store.
    A line without an order is tried again, with every later batch and by
    :func:`settle_weekly_sales`, until its order comes, so it counts once, whenever that is. An
    order waits in ``held_orders`` (the orders stored by then); one that is not stored there yet
    waits beside the table for lines whose time of arrival is at most ``wait`` from its own."""
    table = weekly_table(fixtures.spark, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        _add_lines(fixtures, table, held_orders, batch, wait, ("lines", batch_id))

    return (_both(lines, orders).writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start())


def settle_weekly_sales(fixtures: Fixtures, path: str, held_orders: Callable[[], DataFrame]) -> int:
    """Try the waiting line items again; the number that still waits."""
    table = weekly_table(fixtures.spark, path)
    waiting = table.beside("waiting")
    if waiting is None or waiting.isEmpty():
        return 0
    _add_lines(fixtures, table, held_orders)
    return table.beside("waiting").count()


def read_weekly_sales(spark: SparkSession, path: str, weeks: tuple[int, int] | None = None) -> DataFrame:
    """The weekly sales in the shape of the raw table; ``weeks`` (first, last) prunes the
    partitions to those weeks of every year."""
    held = weekly_table(spark, path).read()
    if weeks:
        held = held.where(F.col("week_number").between(*weeks))
    return Fixtures.weekly_rows(held.select(*WEEKLY_KEYS, "transactions", "sales"))


def _merged_days(stream: DataFrame, path: str, checkpoint_location: str,
                 part_of: Callable[[DataFrame], DataFrame], together: Callable[[DataFrame], DataFrame],
                 partition: str):
    """Merge what ``part_of`` makes of each micro-batch into the partitions it touches."""
    table = VersionedTable(stream.sparkSession, path, (partition,))

    def write(batch: DataFrame, batch_id: int) -> None:
        table.merge(part_of(batch), together, ("batch", batch_id))

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_location)
            .trigger(availableNow=True).start())


def funnel_refresh(new_events: DataFrame, path: str, checkpoint_location: str):
    """Merge arriving raw events into the stored visit pages of the funnels, by visit day."""
    def part(raw: DataFrame) -> DataFrame:
        events = shaped_events(raw).where(F.col("event_type").isNotNull())
        return visit_pages(events).withColumn(
            "visit_day", F.date_format(F.to_date(F.substring_index("visit_id", "-", -1), "yyyyMMdd"), "yyyy-MM-dd"))

    def together(rows: DataFrame) -> DataFrame:
        return rows.groupBy("visit_id", "page_id", "visit_day").agg(
            F.sum("views").alias("views"), F.sum("carts").alias("carts"), F.max("purchased").alias("purchased"))

    return _merged_days(new_events, path, checkpoint_location, part, together, "visit_day")


def read_funnel(spark: SparkSession, path: str, pages: DataFrame) -> DataFrame:
    """The product funnel from the stored visit pages."""
    return funnel_of(VersionedTable(spark, path, ("visit_day",)).read(), pages)


def user_days_refresh(new_events: DataFrame, path: str, checkpoint_location: str):
    """Keep the users of each day as bitmaps: a bit for each user id, in pieces of 32,768 ids.
    Bitmaps of batches are or-ed, so distinct counts stay exact without the raw events, however
    often a user returns."""
    def part(raw: DataFrame) -> DataFrame:
        seen = raw.where(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
        return seen.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"),
                            F.bitmap_bucket_number("user_id").alias("piece")) \
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("user_id")).alias("users"))

    def together(rows: DataFrame) -> DataFrame:
        return rows.groupBy("day", "piece").agg(F.bitmap_or_agg("users").alias("users"))

    return _merged_days(new_events, path, checkpoint_location, part, together, "day")


def monthly_visitors(spark: SparkSession, path: str) -> DataFrame:
    """``month``, ``visit_count`` (user days) and ``user_count`` (distinct users of the month, of any
    year) from the stored bitmaps."""
    held = VersionedTable(spark, path, ("day",)).read().withColumn("day", F.to_date("day"))
    pieces = held.groupBy(F.month("day").alias("month_number"), month_name("day").alias("month"), "piece").agg(
        F.sum(F.bitmap_count("users")).alias("visits"), F.bitmap_or_agg("users").alias("users"))
    return pieces.groupBy("month_number", "month").agg(
        F.sum("visits").alias("visit_count"), F.sum(F.bitmap_count("users")).alias("user_count")) \
        .orderBy("month_number").select("month", "visit_count", "user_count")


def clean_on_arrival(raw_stream: DataFrame, cleaner: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply a batch cleaning function to a stream (narrow projection only)."""
    return cleaner(raw_stream)
