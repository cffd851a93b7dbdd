"""Flags of arriving changes against the checks of the finished log."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SMALL_SF
from ledgerlens.operators import quality as Q
from ledgerlens.streaming.changes import flagged_changes, remembered_dates, watch_changes


def _watched(spark, log, parts, **parameters):
    work = tempfile.mkdtemp(prefix="ll-changes-")
    for where in parts:  # each part arrives, and is flagged, before the next
        log.where(where).write.mode("append").parquet(f"{work}/log")
        stream = spark.readStream.schema(log.schema).parquet(f"{work}/log")
        watch_changes(stream, "k", "d", "n", f"{work}/out", f"{work}/ckpt", **parameters).awaitTermination()
    return f"{work}/out"


def test_stream_equals_the_checks_of_the_log(spark):
    orders = spark.read.parquet(os.path.join(SMALL_SF, "orders.parquet"))
    log = orders.select((F.col("o_custkey") % 40).alias("k"), F.to_date("o_orderdate").alias("d"),
                        F.col("o_orderkey").alias("n"))
    cut = log.approxQuantile("n", [0.3, 0.7], 0.01)
    out = _watched(spark, log, [f"n < {cut[0]}", f"n >= {cut[0]} AND n < {cut[1]}", f"n >= {cut[1]}"])
    got = flagged_changes(spark, out)
    assert got.count() == log.count()
    late = Q.out_of_order(log, "k", "d", "n")
    assert sorted(r["arrival"] for r in got.where("late").collect()) == sorted(r["n"] for r in late.collect())
    twice = {(str(r["k"]), r["d"]): r["copies"] for r in Q.same_key_same_date(log, "k", "d").collect()}
    again = got.where("again").groupBy("key", "changed_on").count().collect()
    assert twice and {(r["key"], r["changed_on"]): r["count"] + 1 for r in again} == twice


def test_old_dates_are_forgotten(spark):
    log = spark.createDataFrame([("a", "2020-01-01", 1), ("a", "2020-03-01", 2), ("b", "2020-01-01", 1),
                                 ("a", "2020-01-01", 3), ("b", "2020-01-01", 2), (None, "2020-01-01", 9), ("a", None, 9)],
                                "k string, d string, n long")
    out = _watched(spark, log, ["n = 1", "n = 2 OR n = 9", "n = 3"], keep=30)
    assert sorted((r["key"], str(r["changed_on"])) for r in remembered_dates(spark, out).collect()) == [
        ("a", "2020-03-01"), ("b", "2020-01-01")]
    flags = {(r["key"], r["arrival"]): (r["late"], r["again"]) for r in flagged_changes(spark, out).collect()}
    assert flags == {("a", 1): (False, False), ("a", 2): (False, False), ("b", 1): (False, False),
                     ("b", 2): (False, True), ("a", 3): (True, False)}
