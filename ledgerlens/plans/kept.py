"""Tables kept current from arriving rows, loads with a contract, and checks of a change log, as
catalogue queries (S3, S4, S11 to S13, F28, X1, X2, X4 to X6).

The given tables arrive as streams of files; what the streams keep is stored under a new folder of
the shared folder, and the result is read from there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import quality as Q
from ..operators.calendar import gaps
from ..operators.intervals import overlapping_intervals
from ..session import shared_folder
from ..sources.fixtures import Fixtures
from ..sources.loads import LoadedTable
from ..sources.sinks import write_table
from ..streaming import changes as ch
from ..streaming import incremental as inc
from . import clickstream as cs
from . import delivery as dl
from . import retail as rt

#: Days of a member's first offer, for the check of overlapping windows.
OFFER_DAYS = 2

RATINGS = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("runner_id", T.IntegerType()),
                        T.StructField("customer_id", T.LongType()), T.StructField("rating", T.IntegerType()),
                        T.StructField("rating_time", T.TimestampNTZType())])


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/kept/{uuid.uuid4().hex}"


def _files(sf_dir: str, table: str) -> str:
    """A pattern for the files of a base table (a streaming source takes folders or patterns)."""
    return f"{sf_dir.rstrip('/')}/{table}.parque[t]"


def _schema(spark: SparkSession, sf_dir: str, table: str) -> T.StructType:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").schema


def weekly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly sales from line items and orders that arrive apart: half of the orders come after all
    line items were read. What waited for them is counted then."""
    fx, folder = Fixtures(spark, sf_dir), _folder(spark)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    early = F.pmod(F.xxhash64("o_orderkey"), F.lit(2)) == 0

    def held():
        return spark.read.schema(orders.schema).parquet(f"{folder}/orders")

    def refresh():
        inc.weekly_sales_refresh(
            fx, inc.arrivals(spark, _files(sf_dir, "lineitem"), _schema(spark, sf_dir, "lineitem")),
            inc.arrivals(spark, f"{folder}/orders", orders.schema), f"{folder}/weekly", f"{folder}/progress",
            held, wait="3650 days").awaitTermination()

    for some in (early, ~early):
        orders.where(some).write.mode("append").parquet(f"{folder}/orders")
        refresh()
    inc.settle_weekly_sales(fx, f"{folder}/weekly", held)
    return rt.clean_weekly_sales(inc.read_weekly_sales(spark, f"{folder}/weekly"))


def category_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark)
    events = inc.event_stream(spark, _files(sf_dir, "events"))
    inc.funnel_refresh(events, f"{folder}/pages", f"{folder}/progress").awaitTermination()
    return cs.category_funnel(inc.read_funnel(spark, f"{folder}/pages", Fixtures(spark, sf_dir).page_hierarchy))


def monthly_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark)
    events = inc.event_stream(spark, _files(sf_dir, "events"))
    inc.user_days_refresh(events, f"{folder}/days", f"{folder}/progress").awaitTermination()
    return inc.monthly_visitors(spark, f"{folder}/days")


def runs_cleaned_on_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw runs arrive as files, are cleaned by the batch projection and appended to a table."""
    fx, folder = Fixtures(spark, sf_dir), _folder(spark)
    write_table(fx.runs_raw, f"{folder}/raw")
    raw = spark.readStream.schema(fx.runs_raw.schema).parquet(f"{folder}/raw")
    (inc.clean_on_arrival(raw, dl.clean_runs).writeStream.format("parquet").outputMode("append")
     .option("path", f"{folder}/clean").option("checkpointLocation", f"{folder}/progress")
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{folder}/clean")


def ratings_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of ratings, the second one with the same orders, and a rerun of the first. Rows by
    outcome and broken rules; every row got a time."""
    fx = Fixtures(spark, sf_dir)
    orders = fx.src.read("orders", "o_orderkey", "o_custkey")
    raw = orders.select(
        F.col("o_orderkey").alias("order_id"), (F.col("o_custkey") % 10 + 1).alias("runner_id"),
        F.col("o_custkey").alias("customer_id"), (F.col("o_orderkey") % 7).alias("rating"),
        F.lit(None).cast("timestamp_ntz").alias("rating_time"))
    delivered = dl.clean_runs(fx.runs_raw).where(F.col("cancellation").isNull())
    table = LoadedTable(spark, f"{_folder(spark)}/ratings", RATINGS, ["order_id"])
    for number in (0, 1, 0):
        table.load(raw, ("ratings", number), dl.rating_rules(), {"order_id": (delivered, "order_id")}, ("rating_time",))
    good = table.accepted().withColumn("broken", F.lit(""))
    bad = table.rejected().withColumn("broken", F.array_join("broken", ", ")).select(*good.columns)
    return good.unionByName(bad).groupBy("broken").agg(
        F.count(F.lit(1)).alias("ratings"), F.count("rating_time").alias("timed"))


def late_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer that were entered (by order key) after one with a later date."""
    orders = Fixtures(spark, sf_dir).src.read("orders", "o_custkey", "o_orderkey", "o_orderdate")
    return Q.out_of_order(orders, "o_custkey", "o_orderdate", "o_orderkey") \
        .select(F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("order_id"))


def same_day_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days on which a customer changed the plan more than once."""
    return Q.same_key_same_date(Fixtures(spark, sf_dir).subscriptions, "customer_id", "start_date")


def late_changes_on_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`late_changes`, flagged while the orders arrive in three parts."""
    folder, orders = _folder(spark), Fixtures(spark, sf_dir).src.read("orders", "o_custkey", "o_orderkey", "o_orderdate")
    low, high = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    third = F.least(F.floor(3 * (F.col("o_orderkey") - F.lit(low)) / F.lit(max(high - low, 1))), F.lit(2))
    for part in range(3):
        write_table(orders.where(third == part), f"{folder}/log", mode="append")
        stream = spark.readStream.schema(orders.schema).parquet(f"{folder}/log")
        ch.watch_changes(stream, "o_custkey", "o_orderdate", "o_orderkey", f"{folder}/watch",
                         f"{folder}/progress").awaitTermination()
    flagged = ch.flagged_changes(spark, f"{folder}/watch").where("late")
    return flagged.select(F.col("key").cast("long").alias("customer_id"), F.col("arrival").alias("order_id"))


def overlapping_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members whose first offer overlaps that of another member."""
    members = Fixtures(spark, sf_dir).members
    offers = members.select("customer_id", "join_date", F.date_add("join_date", OFFER_DAYS).alias("last_date"))
    return overlapping_intervals(offers, "customer_id", "join_date", "last_date")


def orders_without_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order numbers, from the first to the last one, of which no line item was ever seen (U3, G1,
    G2): a generated series less the numbers that occur."""
    source = Fixtures(spark, sf_dir).src
    first, last = source.read("orders", "o_orderkey").agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return gaps(spark, source.read("lineitem", "l_orderkey"), "l_orderkey", first or 0, last if last is not None else -1,
                "order_id", "bigint")


QUERIES = {
    "kept_weekly_sales": weekly_sales,
    "kept_category_funnel": category_funnel,
    "kept_monthly_visitors": monthly_visitors,
    "kept_clean_runs": runs_cleaned_on_arrival,
    "loaded_ratings": ratings_loaded,
    "log_late_changes": late_changes,
    "kept_late_changes": late_changes_on_arrival,
    "log_same_day_changes": same_day_changes,
    "loyalty_overlapping_offers": overlapping_offers,
    "orders_without_items": orders_without_items,
}
