"""Generators over calendars: integer series, gap finder, recurring schedules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def series(spark: SparkSession, lo: int, hi: int, name: str = "n", kind: str = "int") -> DataFrame:
    """Whole numbers ``lo..hi`` inclusive, generated in parallel by ``spark.range``."""
    return spark.range(lo, hi + 1).select(F.col("id").cast(kind).alias(name))


def gaps(spark: SparkSession, present: DataFrame, col: str, lo: int, hi: int,
         name: str, kind: str = "int") -> DataFrame:
    """Values of ``lo..hi`` that never occur in ``present[col]`` (EXCEPT DISTINCT;
    planned as a distinct + anti join, the present side pre-aggregated)."""
    return series(spark, lo, hi, name, kind).subtract(
        present.select(F.col(col).cast(kind).alias(name)).distinct())


def monthly_dates(start: Column, bound: Column) -> Column:
    """Monthly recurrence from ``start`` up to ``bound`` inclusive, each date one
    month after the previous one (so a clamped day keeps drifting: Jan 31,
    Feb 29, Mar 29), as an array.

    A fold over ``sequence(1, n)`` builds the chain in one expression per row;
    ``n`` (calendar months between start and bound) bounds the steps exactly,
    so there is no recursion and no shuffle."""
    months = ((F.year(bound) * 12 + F.month(bound)) - (F.year(start) * 12 + F.month(start)))
    steps = F.sequence(F.lit(1), F.greatest(months, F.lit(1)))
    chain = F.aggregate(steps, F.array(start),
                        lambda acc, _: F.concat(acc, F.array(F.add_months(F.element_at(acc, -1), 1))))
    return F.filter(chain, lambda d: d <= bound)


def recurring_schedule(df: DataFrame, start_col: str, bound_col: str, repeat: Column,
                       out_col: str) -> DataFrame:
    """One row per billing date: rows where ``repeat`` holds recur monthly until
    ``bound_col`` (inclusive); other rows (annual, terminal) occur once."""
    start, bound = F.col(start_col), F.col(bound_col)
    dates = F.when(repeat, monthly_dates(start, bound)).otherwise(F.array(start))
    # explode_outer + NULL filter: an inner explode lets the optimizer push an
    # inferred size(dates) > 0 filter down, which would evaluate the fold twice.
    return df.withColumn(out_col, F.explode_outer(dates)).where(F.col(out_col).isNotNull())
