"""Adapters that derive the case-study table shapes from the driver's tables.

Every adapter is a lazy DataFrame over the Parquet scans, so each derived
table grows with the data. The small reference dimensions (menu-like item
types, recipes, toppings, plans, page hierarchy, event names, campaigns) are
literal rows whose size is fixed by construction; only those are broadcast.
The DuckDB twin of every adapter lives in ``ledgerlens.plans.oracle.fixtures``.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import int_div
from .tables import TableSource

# ---------------------------------------------------------------------------
# Fixed values (must equal the case-study seed data for the golden facts)
# ---------------------------------------------------------------------------
ITEM_TYPES = [(1, "Meatlovers"), (2, "Vegetarian")]
RECIPES = [(1, "1, 2, 3, 4, 5, 6, 8, 10"), (2, "4, 6, 7, 9, 11, 12")]
TOPPINGS = [(1, "Bacon"), (2, "BBQ Sauce"), (3, "Beef"), (4, "Cheese"), (5, "Chicken"),
            (6, "Mushrooms"), (7, "Onions"), (8, "Pepperoni"), (9, "Peppers"),
            (10, "Salami"), (11, "Tomatoes"), (12, "Tomato Sauce")]
PLANS = [(0, "trial", "0.00"), (1, "basic monthly", "9.90"), (2, "pro monthly", "19.90"),
         (3, "pro annual", "199.00"), (4, "churn", None)]
PAGES = [(1, "Home Page", None, None), (2, "All Products", None, None),
         (3, "Salmon", "Fish", 1), (4, "Kingfish", "Fish", 2), (5, "Tuna", "Fish", 3),
         (6, "Russian Caviar", "Luxury", 4), (7, "Black Truffle", "Luxury", 5),
         (8, "Abalone", "Shellfish", 6), (9, "Lobster", "Shellfish", 7),
         (10, "Crab", "Shellfish", 8), (11, "Oyster", "Shellfish", 9),
         (12, "Checkout", None, None), (13, "Confirmation", None, None)]
EVENT_TYPES = [(1, "Page View"), (2, "Add to Cart"), (3, "Purchase"),
               (4, "Ad Impression"), (5, "Ad Click")]
CAMPAIGNS = [
    (1, "1-3", "BOGOF - Fishing For Compliments", "2024-01-01 00:00:00", "2024-01-10 00:00:00"),
    (2, "4-5", "25% Off - Living The Lux Life", "2024-01-11 00:00:00", "2024-01-18 00:00:00"),
    (3, "6-8", "Half Off - Treat Your Shellf(ish)", "2024-01-22 00:00:00", "2024-01-30 00:00:00"),
]
# Source event names -> case-study event codes.
EVENT_CODES = {"view": 1, "signup": 2, "purchase": 3, "error": 4, "click": 5}
# Market segment -> weekly-sales segment code; order priority -> customer type.
SEGMENT_CODES = {"AUTOMOBILE": "C1", "BUILDING": "F2", "FURNITURE": "C3", "HOUSEHOLD": "F4"}
CUSTOMER_TYPES = {"1-URGENT": "New", "2-HIGH": "New", "3-MEDIUM": "Existing"}
# Order priority -> plan id after the trial.
PRIORITY_PLANS = {"1-URGENT": 3, "2-HIGH": 2, "5-LOW": 4}

# Adapter parameters.
SUBSCRIPTION_EPOCH = dt.date(1995, 1, 1)
SUBSCRIPTION_START = dt.date(2020, 1, 1)
RETAIL_SHIFT_DAYS = 7308            # 1044 weeks: Mondays stay Mondays, 1995 -> 2015
WEEKLY_KEYS = ("wk", "region", "platform", "segment", "customer_type")
ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderpriority")
LINE_COLUMNS = ("l_orderkey", "l_extendedprice", "l_returnflag", "l_shipdate")
RUNNER_COUNT = 10
RUNNER_ANCHOR = dt.date(2021, 1, 1)


def _case(col, mapping: dict, default):
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v)))
    return expr.otherwise(default if not isinstance(default, (str, int)) else F.lit(default))


def _list_text(selector, x):
    """Dirty CSV id list used for exclusions / extras: 'null', '', NULL, one id,
    two ids (sometimes equal), or ' NaN '."""
    a = (x % 12 + 1).cast("string")
    b = (int_div(x, 12) % 12 + 1).cast("string")
    return (F.when(selector == 0, F.lit("null"))
            .when(selector == 1, F.lit(""))
            .when(selector == 2, F.lit(None).cast("string"))
            .when(selector == 3, a)
            .when(selector == 4, F.concat(a, F.lit(", "), b))
            .otherwise(F.lit(" NaN ")))


def shaped_events(raw: DataFrame) -> DataFrame:
    """Raw events as clickstream rows (a visit is a user's calendar day); events of a visit are
    ordered by (event_time, event_id)."""
    visit = F.concat(F.col("user_id").cast("string"), F.lit("-"),
                     F.date_format(F.to_date("ts"), "yyyyMMdd"))
    page = F.get_json_object("props", "$.k").cast("int") % 13 + 1
    return raw.select(visit.alias("visit_id"), F.col("user_id").cast("string").alias("cookie_id"),
                      page.cast("int").alias("page_id"),
                      _case(F.col("event_type"), EVENT_CODES, F.lit(None).cast("int")).cast("int")
                      .alias("event_type"),
                      "event_id", F.col("ts").alias("event_time"))


class Fixtures:
    """Lazily-built case-study tables over one scale-factor folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.src = TableSource(spark, root)

    # -- literal dimensions (fixed size: safe to broadcast) ---------------
    def _literal(self, rows, schema: str) -> DataFrame:
        """Literal rows as a SQL VALUES relation: a JVM-side LocalRelation (no
        Python RDD, so no Python worker is started to read it)."""
        fields = [f.strip().split(" ", 1) for f in schema.split(",")]

        def lit(v):
            if v is None:
                return "NULL"
            if isinstance(v, str):
                return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
            return repr(v)

        body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
        names = ", ".join(n for n, _ in fields)
        casts = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in fields)
        return self.spark.sql(f"SELECT {casts} FROM VALUES {body} AS t({names})")

    @cached_property
    def item_types(self) -> DataFrame:
        return self._literal(ITEM_TYPES, "item_type_id int, item_name string")

    @cached_property
    def recipes(self) -> DataFrame:
        return self._literal(RECIPES, "item_type_id int, toppings string")

    @cached_property
    def toppings(self) -> DataFrame:
        return self._literal(TOPPINGS, "topping_id int, topping_name string")

    @cached_property
    def plans(self) -> DataFrame:
        return (self._literal(PLANS, "plan_id int, plan_name string, price string")
                .withColumn("price", F.col("price").cast("decimal(5,2)")))

    @cached_property
    def page_hierarchy(self) -> DataFrame:
        return self._literal(PAGES, "page_id int, page_name string, product_category string, "
                                    "product_id int")

    @cached_property
    def event_identifier(self) -> DataFrame:
        return self._literal(EVENT_TYPES, "event_type int, event_name string")

    @cached_property
    def campaigns(self) -> DataFrame:
        return (self._literal(CAMPAIGNS, "campaign_id int, products string, campaign_name string, "
                                         "start_date string, end_date string")
                .withColumn("start_date", F.col("start_date").cast("timestamp_ntz"))
                .withColumn("end_date", F.col("end_date").cast("timestamp_ntz")))

    # -- loyalty (case 1) --------------------------------------------------
    @property
    def sales(self) -> DataFrame:
        li = self.src.read("lineitem", "l_orderkey", "l_partkey")
        o = self.src.read("orders", "o_orderkey", "o_custkey", "o_orderdate")
        return (li.join(o, li.l_orderkey == o.o_orderkey)
                .select(F.col("o_custkey").alias("customer_id"),
                        F.to_date("o_orderdate").alias("order_date"),
                        F.col("l_partkey").alias("product_id")))

    @property
    def menu(self) -> DataFrame:
        return self.src.read("part", "p_partkey", "p_name", "p_retailprice").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("price"))

    @property
    def members(self) -> DataFrame:
        """Customers with a non-negative balance join one year after their first order."""
        o = self.src.read("orders", "o_custkey", "o_orderdate")
        c = self.src.read("customer", "c_custkey", "c_acctbal").where(F.col("c_acctbal") >= 0)
        return (o.join(c, o.o_custkey == c.c_custkey, "left_semi")
                .groupBy(F.col("o_custkey").alias("customer_id"))
                .agg(F.date_add(F.to_date(F.min("o_orderdate")), 365).alias("join_date")))

    # -- delivery (case 2) -------------------------------------------------
    @staticmethod
    def _order_time(o: DataFrame):
        secs = (F.col("o_orderkey") * 37) % 86400
        return F.timestamp_add("SECOND", secs, F.col("o_orderdate"))

    @property
    def order_items_raw(self) -> DataFrame:
        li = self.src.read("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
        o = self.src.read("orders", "o_orderkey", "o_custkey", "o_orderdate")
        j = li.join(o, li.l_orderkey == o.o_orderkey)
        return j.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            (F.col("l_partkey") % 2 + 1).cast("int").alias("item_type_id"),
            _list_text(F.col("l_linenumber") % 6, F.col("l_suppkey")).alias("exclusions"),
            _list_text((F.col("l_linenumber") + 3) % 6, F.col("l_partkey")).alias("extras"),
            self._order_time(j).alias("order_time"))

    @property
    def runs_raw(self) -> DataFrame:
        o = self.src.read("orders", "o_orderkey", "o_custkey", "o_orderdate")
        k = F.col("o_orderkey")
        cancelled = (k % 7) == 0
        pickup = F.timestamp_add("SECOND", (k % 60) * 60 + 30, self._order_time(o))
        d10 = k % 250 + 10
        dist = F.concat(int_div(d10, 10).cast("string"),
                        F.when(d10 % 10 == 0, F.lit("")).otherwise(
                            F.concat(F.lit("."), (d10 % 10).cast("string"))),
                        _case(k % 4, {0: "km", 1: " km", 2: ""}, "KM"))
        dur = F.concat((k % 40 + 10).cast("string"),
                       _case(int_div(k, 4) % 5, {0: "minutes", 1: "mins", 2: " minute", 3: ""}, " MINS"))
        cancel = F.when(cancelled, F.when(k % 2 == 0, F.lit("Restaurant Cancellation"))
                        .otherwise(F.lit("Customer Cancellation"))) \
            .when(k % 3 == 0, F.lit("null")).when(k % 3 == 1, F.lit("")) \
            .otherwise(F.lit(None).cast("string"))
        null_txt = F.lit("null")
        return o.select(
            k.alias("order_id"),
            (F.col("o_custkey") % RUNNER_COUNT + 1).cast("int").alias("runner_id"),
            F.when(cancelled, null_txt).otherwise(
                pickup.cast("string")).alias("pickup_time"),     # naive text, zone-free
            F.when(cancelled, null_txt).otherwise(dist).alias("distance"),
            F.when(cancelled, null_txt).otherwise(dur).alias("duration"),
            cancel.alias("cancellation"))

    @property
    def runners(self) -> DataFrame:
        o = self.src.read("orders", "o_custkey")
        rid = (F.col("o_custkey") % RUNNER_COUNT + 1).cast("int")
        return (o.select(rid.alias("runner_id")).distinct()
                .withColumn("registration_date",
                            F.date_add(F.lit(RUNNER_ANCHOR), F.col("runner_id") * 3)))

    @property
    def ratings(self) -> DataFrame:
        """One rating per delivered (not cancelled) order, 1..5."""
        o = self.src.read("orders", "o_orderkey", "o_custkey", "o_orderdate")
        k = F.col("o_orderkey")
        return o.where((k % 7) != 0).select(
            k.alias("order_id"),
            (F.col("o_custkey") % RUNNER_COUNT + 1).cast("int").alias("runner_id"),
            F.col("o_custkey").alias("customer_id"),
            (k % 5 + 1).cast("int").alias("rating"),
            F.timestamp_add("HOUR", F.lit(2), self._order_time(o)).alias("rating_time"))

    # -- subscriptions (case 3) --------------------------------------------
    @property
    def subscriptions(self) -> DataFrame:
        o = self.src.read("orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
        days = F.datediff(F.to_date("o_orderdate"), F.lit(SUBSCRIPTION_EPOCH))
        start = F.date_add(F.lit(SUBSCRIPTION_START), int_div(days, 5).cast("int"))
        changes = o.select(F.col("o_custkey").alias("customer_id"), start.alias("start_date"),
                           "o_orderkey", "o_orderpriority")
        # Every order is a change. The trial is the customer's first one: an aggregate joined
        # back, which stays partial and lets a very active customer be split.
        firsts = changes.groupBy("customer_id").agg(
            F.min(F.struct("start_date", "o_orderkey")).alias("first"))
        j = changes.join(firsts, "customer_id")
        plan = (F.when(F.col("o_orderkey") == F.col("first.o_orderkey"), F.lit(0))
                .otherwise(_case(F.col("o_orderpriority"), PRIORITY_PLANS, 1)))
        return j.select("customer_id", plan.cast("int").alias("plan_id"), "start_date")

    # -- retail (case 5) ---------------------------------------------------
    @property
    def weekly_sales_raw(self) -> DataFrame:
        return self.weekly_sales()

    def weekly_sales(self, dates: list[tuple[dt.date, dt.date]] | None = None,
                     outside: tuple[dt.date, dt.date] | None = None) -> DataFrame:
        """Weekly sales, or those whose week date lies in one of ``dates`` (end excluded) or not
        in ``outside``. The dates become ranges of ``l_shipdate``, which the scan takes."""
        li = self.src.read("lineitem", "l_orderkey", "l_extendedprice", "l_returnflag", "l_shipdate")
        if dates is not None:
            li = li.where(self._shipped(dates, outside))
        return self.weekly_rows(self.weekly_parts(li))

    @staticmethod
    def _shipped(dates, outside):
        """Ship dates of the weeks that start in a range; a week begins on its Monday."""
        shift, ship = dt.timedelta(days=RETAIL_SHIFT_DAYS), F.col("l_shipdate")

        def at(d):
            return F.lit(dt.datetime.combine(d - shift, dt.time())).cast("timestamp_ntz")

        found = F.lit(False)
        for lo, hi in dates:
            found = found | ((ship >= at(lo)) & (ship < at(hi + dt.timedelta(days=6))))
        if outside:
            found = found | (ship < at(outside[0])) | (ship >= at(outside[1]))
        return found

    def weekly_parts(self, li: DataFrame) -> DataFrame:
        """Weekly sums of any part of the line items; sums of parts add up."""
        o = self.src.read("orders", *ORDER_COLUMNS)
        # Resolve each order's region and segment on the order side first, so
        # the line items (the largest table) are shuffled once, on the order key.
        order_attrs = self.with_places(o, "inner")
        return self.weekly_sums(li.join(order_attrs, li.l_orderkey == order_attrs.o_orderkey))

    def with_places(self, orders: DataFrame, how: str) -> DataFrame:
        """Orders, or rows with the columns of one, with the region (``r_name``) and the segment
        of their customer."""
        c = self.src.read("customer", "c_custkey", "c_nationkey", "c_mktsegment")
        n = self.src.read("nation", "n_nationkey", "n_regionkey")
        r = self.src.read("region", "r_regionkey", "r_name")
        geo = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        places = c.join(geo, F.col("c_nationkey") == F.col("n_nationkey")) \
            .select("c_custkey", "c_mktsegment", "r_name")
        return orders.join(places, F.col("o_custkey") == F.col("c_custkey"), how)

    @staticmethod
    def weekly_sums(placed: DataFrame) -> DataFrame:
        """Weekly sums of line items that have their order, region and segment."""
        ship = F.to_date("l_shipdate")
        monday = F.date_sub(ship, (F.dayofweek(ship) + 5) % 7)     # Sunday=1 .. Saturday=7
        keyed = placed.select(
            F.date_add(monday, RETAIL_SHIFT_DAYS).alias("wk"),
            F.col("r_name").alias("region"),
            F.when(F.col("l_returnflag") == "R", F.lit("Shopify")).otherwise(F.lit("Retail"))
             .alias("platform"),
            _case(F.col("c_mktsegment"), SEGMENT_CODES, "null").alias("segment"),
            _case(F.col("o_orderpriority"), CUSTOMER_TYPES, "Guest").alias("customer_type"),
            F.round("l_extendedprice").cast("bigint").alias("price"))
        return keyed.groupBy(*WEEKLY_KEYS).agg(F.count(F.lit(1)).alias("transactions"),
                                               F.sum("price").alias("sales"))

    @staticmethod
    def weekly_rows(parts: DataFrame) -> DataFrame:
        """Weekly sums in the shape of the raw table."""
        return parts.select(F.date_format("wk", "d/M/yy").alias("week_date"), "region", "platform",
                            "segment", "customer_type", F.col("transactions").cast("int").alias("transactions"),
                            "sales")

    # -- clickstream (case 6) ----------------------------------------------
    @property
    def users(self) -> DataFrame:
        ev = self.src.read("events", "user_id", "ts")
        return (ev.groupBy("user_id").agg(F.min("ts").alias("start_date"))
                .select(int_div(F.col("user_id"), 3).alias("user_id"),
                        F.col("user_id").cast("string").alias("cookie_id"), "start_date"))

    @property
    def web_events(self) -> DataFrame:
        return shaped_events(self.src.read("events", "event_id", "ts", "user_id", "event_type", "props"))
