"""Rank, row number, lag and lead inside groups without putting a group in one task.

A window ``PARTITION BY key ORDER BY o`` sends every row of a key to one task, so one key
holding a third of the data is sorted by one task. Here rows that are equal in every column are
first counted as one (partially, before the shuffle), and the rows of a key are cut by period (the
day of the leading order column, or any expression that never falls along the order). The rows are
shuffled once, by key and period; windows run inside a period, and so does the aggregate that
carries a period's count and its first and last row. A window over these few rows (for days, at
most as many as the calendar has) stitches the periods together, and a join that needs no
further shuffle of the rows brings the stitches back. Last, counted rows become rows again. The
plan is the same at any size and runs nothing while it is built.

So a customer with a third of all rows is spread over the days, and equal rows of one day cost
one. Different rows of one key and period are sorted by one task.

Rows that tie on the whole order are numbered in an arbitrary order, as ROW_NUMBER does; make
the order total where that matters. ``rank`` ties on the leading order column only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def day_of(order_col: str) -> Column:
    """The default period of a date or time column."""
    return F.to_date(F.col(order_col))


def sequence_columns(df: DataFrame, keys: list[str], order: list[str],
                     lags: dict[str, str] | None = None, leads: dict[str, str] | None = None,
                     row_number: str | None = None, rank: str | None = None,
                     period: Column | None = None) -> DataFrame:
    """Add ``lags`` (new column -> source column, previous row in the key), ``leads`` (next
    row), ``row_number`` and ``rank`` (1-based position in the key, by the whole order and by
    the leading order column)."""
    lags, leads, columns = lags or {}, leads or {}, df.columns
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    # a struct compares its fields null-safely, so shuffle, windows and join agree on it
    at = F.struct(*keys, (day_of(order[0]) if period is None else period).alias("__period"))
    cut = counted.withColumn("__at", at).repartition("__at")

    place, whole = F.struct(*order), F.struct(*columns)
    borders = cut.groupBy("__at").agg(
        F.sum("__n").alias("__in"), F.min_by(whole, place).alias("__head"), F.max_by(whole, place).alias("__tail"))
    along = Window.partitionBy(*[f"__at.{k}" for k in keys]).orderBy("__at.__period")
    stitches = borders.select(
        F.col("__at").alias("__key"),
        F.coalesce(F.sum("__in").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"),
        F.lag("__tail").over(along).alias("__prev"), F.lead("__head").over(along).alias("__next"))
    out = cut.join(stitches, F.col("__at") == F.col("__key"))

    inside = Window.partitionBy("__at").orderBy(*order)
    earlier = F.coalesce(F.sum("__n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edge = {"__first": F.lag(F.lit(True)).over(inside).isNull(), "__last": F.lead(F.lit(True)).over(inside).isNull()}
    out = out.withColumns({
        "__start": F.col("__before") + earlier, **edge,
        **{f"__lag_{n}": F.lag(c).over(inside) for n, c in lags.items()},
        **{f"__lead_{n}": F.lead(c).over(inside) for n, c in leads.items()}})
    if rank:
        ties = Window.partitionBy("__at", order[0])
        out = out.withColumn("__rank", F.min("__start").over(ties) + 1)
    out = out.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__n"))))
    again, more = F.col("__copy") > 1, F.col("__copy") < F.col("__n")
    made = {n: F.when(again, F.col(c)).when(F.col("__first"), F.col("__prev")[c]).otherwise(F.col(f"__lag_{n}"))
            for n, c in lags.items()}
    made |= {n: F.when(more, F.col(c)).when(F.col("__last"), F.col("__next")[c]).otherwise(F.col(f"__lead_{n}"))
             for n, c in leads.items()}
    if row_number:
        made[row_number] = (F.col("__start") + F.col("__copy")).cast("bigint")
    if rank:
        made[rank] = F.col("__rank").cast("bigint")
    return out.select(*columns, *[c.alias(n) for n, c in made.items()])
