"""Golden frames shaped like the case-study seed tables.

Fixed values: the rows below are the published seed data of the case
studies, so the published answers can be asserted exactly.
"""

import datetime as dt

D = dt.date
TS = dt.datetime.fromisoformat

# Loyalty seed: sales (customer, date, product), menu, members.
SALES = [("A", "2021-01-01", 1), ("A", "2021-01-01", 2), ("A", "2021-01-07", 2),
         ("A", "2021-01-10", 3), ("A", "2021-01-11", 3), ("A", "2021-01-11", 3),
         ("B", "2021-01-01", 2), ("B", "2021-01-02", 2), ("B", "2021-01-04", 1),
         ("B", "2021-01-11", 1), ("B", "2021-01-16", 3), ("B", "2021-02-01", 3),
         ("C", "2021-01-01", 3), ("C", "2021-01-01", 3), ("C", "2021-01-07", 3)]
MENU = [(1, "sushi", 10), (2, "curry", 15), (3, "ramen", 12)]
MEMBERS = [("A", "2021-01-07"), ("B", "2021-01-09")]

# Delivery seed: order items (order, customer, item type, exclusions, extras, time)
# and runs (order, runner, pickup, distance, duration, cancellation).
ORDER_ITEMS = [
    (1, 101, 1, "", "", "2020-01-01 18:05:02"), (2, 101, 1, "", "", "2020-01-01 19:00:52"),
    (3, 102, 1, "", "", "2020-01-02 23:51:23"), (3, 102, 2, "", None, "2020-01-02 23:51:23"),
    (4, 103, 1, "4", "", "2020-01-04 13:23:46"), (4, 103, 1, "4", "", "2020-01-04 13:23:46"),
    (4, 103, 2, "4", "", "2020-01-04 13:23:46"), (5, 104, 1, "null", "1", "2020-01-08 21:00:29"),
    (6, 101, 2, "null", "null", "2020-01-08 21:03:13"),
    (7, 105, 2, "null", "1", "2020-01-08 21:20:29"),
    (8, 102, 1, "null", "null", "2020-01-09 23:54:33"),
    (9, 103, 1, "4", "1, 5", "2020-01-10 11:22:59"),
    (10, 104, 1, "null", "null", "2020-01-11 18:34:49"),
    (10, 104, 1, "2, 6", "1, 4", "2020-01-11 18:34:49")]
RUNS = [(1, 1, "2020-01-01 18:15:34", "20km", "32 minutes", ""),
        (2, 1, "2020-01-01 19:10:54", "20km", "27 minutes", ""),
        (3, 1, "2020-01-03 00:12:37", "13.4km", "20 mins", None),
        (4, 2, "2020-01-04 13:53:03", "23.4", "40", None),
        (5, 3, "2020-01-08 21:10:57", "10", "15", None),
        (6, 3, "null", "null", "null", "Restaurant Cancellation"),
        (7, 2, "2020-01-08 21:30:45", "25km", "25mins", "null"),
        (8, 2, "2020-01-10 00:15:02", "23.4 km", "15 minute", "null"),
        (9, 2, "null", "null", "null", "Customer Cancellation"),
        (10, 1, "2020-01-11 18:50:20", "10km", "10minutes", "null")]

# Subscription seed rows for customers 1 and 16.
SUBSCRIPTIONS = [(1, 0, "2020-08-01"), (1, 1, "2020-08-08"), (16, 0, "2020-05-31"),
                 (16, 1, "2020-06-07"), (16, 3, "2020-10-21")]


def frames(spark):
    from pyspark.sql import functions as F
    sales = spark.createDataFrame(SALES, "customer_id string, order_date string, product_id int") \
        .withColumn("order_date", F.to_date("order_date"))
    menu = spark.createDataFrame(MENU, "product_id int, product_name string, price int")
    members = spark.createDataFrame(MEMBERS, "customer_id string, join_date string") \
        .withColumn("join_date", F.to_date("join_date"))
    items = spark.createDataFrame(
        ORDER_ITEMS, "order_id int, customer_id int, item_type_id int, exclusions string, "
                     "extras string, order_time string") \
        .withColumn("order_time", F.col("order_time").cast("timestamp_ntz"))
    runs = spark.createDataFrame(
        RUNS, "order_id int, runner_id int, pickup_time string, distance string, "
              "duration string, cancellation string")
    subs = spark.createDataFrame(SUBSCRIPTIONS, "customer_id int, plan_id int, start_date string") \
        .withColumn("start_date", F.to_date("start_date"))
    return dict(sales=sales, menu=menu, members=members, items=items, runs=runs, subs=subs)
