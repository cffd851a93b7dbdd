"""Checks of a change log as it arrives (X5): changes that come twice or out of order.

``watch_changes`` gives every arriving change two flags, as ``quality.out_of_order`` and
``quality.same_key_same_date`` find them in a finished log: ``late`` if a change of the key that
arrived before has a later date, ``again`` if one of the same date arrived before.

What is remembered of a key is its dates, one row each with the number of changes, in a versioned
table dealt to a fixed number of parts by the key; a micro-batch reads and rewrites the parts that
it touches. Dates more than ``keep`` days before the key's last one are forgotten, so a key's rows
are bounded by the calendar: such changes are still found ``late``, but no longer ``again``. Flags
are appended under the number of the micro-batch before the memory takes it in, and either step is
skipped if it is done, so a batch that is run again flags and counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.sequences import sequence_columns
from ..sources.versions import VersionedTable

#: Parts of the remembered dates.
PARTS = 16


def _memory(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, f"{path}/dates", ("part",))


def _flags(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, f"{path}/flags")


def watch_changes(changes: DataFrame, key: str, date_col: str, arrival_col: str, path: str,
                  checkpoint_location: str, keep: int = 3650):
    """Flag arriving ``changes``; ``arrival_col`` numbers them in the order of arrival. Changes without
    a key or a date are left out. See :func:`flagged_changes`."""
    rows = changes.where(F.col(key).isNotNull() & F.col(date_col).isNotNull()).select(
        F.col(key).cast("string").alias("key"), F.to_date(date_col).alias("changed_on"),
        F.col(arrival_col).cast("long").alias("arrival"))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        memory, flags, load = _memory(spark, path), _flags(spark, path), ("changes", batch_id)
        if (done := memory.current()) and done.applied.get(load[0], -1) >= batch_id:
            return
        batch = memory.staged(batch.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(PARTS)).cast("int")))
        held = memory.read(done) if done else None
        flags.append(_flagged(batch, held), load)
        memory.merge(batch.groupBy("part", "key", "changed_on").agg(F.count(F.lit(1)).alias("changes")),
                     lambda dates: _remembered(dates, keep), load)

    return (rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_location)
            .trigger(availableNow=True).start())


def _flagged(batch: DataFrame, held: DataFrame | None) -> DataFrame:
    """``key, changed_on, arrival, late, again`` of a batch, given the dates remembered before it.

    Inside the batch the last date so far is a running maximum by blocks of arrivals (no key is
    held by one window), and a change comes again if its place among those of its key and date
    is not the first."""
    block = F.floor(F.col("arrival") / 100_000)
    past = (Window.unboundedPreceding, -1)
    rows = batch.withColumn("block", block)
    blocks = rows.groupBy("key", "block").agg(F.max("changed_on").alias("most"))
    blocks = blocks.select(
        F.col("key").alias("b_key"), F.col("block").alias("b_block"),
        F.max("most").over(Window.partitionBy("key").orderBy("block").rowsBetween(*past)).alias("before"))
    rows = rows.join(blocks, (F.col("key") == F.col("b_key")) & (F.col("block") == F.col("b_block")))
    inside = F.max("changed_on").over(Window.partitionBy("key", "block").orderBy("arrival").rowsBetween(*past))
    rows = rows.withColumn("so_far", F.greatest("before", inside)).select("key", "changed_on", "arrival", "so_far")
    rows = sequence_columns(rows, ["key", "changed_on"], ["arrival"], row_number="place",
                            period=F.floor(F.col("arrival") / 100_000))
    if held is None:
        last, known = F.lit(None).cast("date"), F.lit(None).cast("long")
    else:
        lasts = held.groupBy(F.col("key").alias("l_key")).agg(F.max("changed_on").alias("last"))
        dates = held.select(F.col("key").alias("d_key"), F.col("changed_on").alias("d_on"), F.col("changes").alias("known"))
        rows = rows.join(lasts, F.col("key") == F.col("l_key"), "left").join(
            dates, (F.col("key") == F.col("d_key")) & (F.col("changed_on") == F.col("d_on")), "left")
        last, known = F.col("last"), F.col("known")
    return rows.select("key", "changed_on", "arrival",
                       F.coalesce(F.greatest("so_far", last) > F.col("changed_on"), F.lit(False)).alias("late"),
                       ((F.col("place") > 1) | known.isNotNull()).alias("again"))


def _remembered(dates: DataFrame, keep: int) -> DataFrame:
    """Dates of each key with their numbers of changes, without those that are too old."""
    each = dates.groupBy("part", "key", "changed_on").agg(F.sum("changes").alias("changes"))
    last = each.groupBy(F.col("key").alias("l_key")).agg(F.max("changed_on").alias("last"))
    return each.join(last, F.col("key") == F.col("l_key")) \
        .where(F.datediff("last", "changed_on") < keep).drop("l_key", "last")


def flagged_changes(spark: SparkSession, path: str) -> DataFrame:
    """``key, changed_on, arrival, late, again`` of all changes that arrived."""
    return _flags(spark, path).read()


def remembered_dates(spark: SparkSession, path: str) -> DataFrame:
    return _memory(spark, path).read()
