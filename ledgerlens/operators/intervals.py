"""Point-in-interval (range) join (J11) and interval validation.

Intervals are dealt to buckets of 1, 16, 256 or 4,096 days: an interval takes the width of which it
covers at most 17 buckets, so a day costs a row and ten years cost 16. A point looks in its
one bucket of each width. The work is an equi-join on (width, bucket) at any size (small interval
tables are broadcast by the planner); the residual condition keeps exact semantics, and a point
and an interval meet in one bucket at most, so nothing is matched twice. Inverted intervals (start
after end) match nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Days of a bucket, narrowest first, and how many buckets of a width an interval may cover
#: before it takes the next one.
WIDTHS, FAN = (1, 16, 256, 4096), 16


def _bucket(day: Column, width: int) -> Column:
    return F.floor(F.unix_date(F.to_date(day)) / F.lit(width)).cast("int")


def dealt_intervals(intervals: DataFrame, start_col: str, end_col: str) -> DataFrame:
    """``intervals`` (those that are not inverted) with a row per bucket (``__width``, ``__bucket``)."""
    start, end = F.col(start_col), F.col(end_col)
    days = F.datediff(F.to_date(end), F.to_date(start)) + 1
    width = F.lit(WIDTHS[-1])
    for w in reversed(WIDTHS[:-1]):
        width = F.when(days <= w * FAN, F.lit(w)).otherwise(width)
    rows = intervals.where(start <= end).withColumn("__width", width)
    w = F.col("__width")
    first, last = (F.floor(F.unix_date(F.to_date(c)) / w).cast("int") for c in (start, end))
    return rows.withColumn("__bucket", F.explode(F.sequence(first, last)))


def interval_join(points: DataFrame, point_col: str, intervals: DataFrame,
                  start_col: str, end_col: str, how: str = "left",
                  inclusive: bool = True, point_key: list[str] | None = None) -> DataFrame:
    """Match each point to every interval with ``start <= point <= end``, or
    ``start <= point < end`` if the end is not ``inclusive``. ``how`` is inner, or left: points
    without an interval stay once. For that the rows of a point are told by ``point_key`` (columns
    that identify a point; all columns by default, equal rows being equal points)."""
    if how not in ("inner", "left"):
        raise ValueError(f"how {how!r}: inner or left")
    looks = F.array(*[F.struct(F.lit(w).alias("__w"), _bucket(F.col(point_col), w).alias("__b")) for w in WIDTHS])
    looking = points.withColumn("__look", F.explode(looks))
    dealt = dealt_intervals(intervals, start_col, end_col).withColumn("__met", F.lit(True))
    p = F.col(point_col)
    before_end = p <= F.col(end_col) if inclusive else p < F.col(end_col)
    met = ((F.col("__look.__w") == F.col("__width")) & (F.col("__look.__b") == F.col("__bucket"))
           & (p >= F.col(start_col)) & before_end)
    out = looking.join(dealt, met, how)
    if how == "left":
        whole = Window.partitionBy(*(point_key or points.columns))
        alone = (F.col("__look.__w") == WIDTHS[0]) & (F.count("__met").over(whole) == 0)
        out = out.withColumn("__keep", F.coalesce("__met", alone)).where("__keep").drop("__keep")
    return out.drop("__look", "__width", "__bucket", "__met")


def overlapping_intervals(intervals: DataFrame, key: str, start_col: str, end_col: str,
                          inclusive: bool = True) -> DataFrame:
    """Rows whose interval overlaps any other one: the windows that would make a range join fan
    out. One row per clashing interval, however many it meets.

    In the order of starts, a row meets an earlier one if the largest end so far reaches its
    start, and a later one if its end reaches the next start. Both run inside the month of the
    start, and over one row per month for what lies outside it, so no task sorts the table."""
    start, end = F.col(start_col), F.col(end_col)
    rows = intervals.where(start <= end).withColumn("__month", F.date_trunc("month", start))
    months = rows.groupBy("__month").agg(F.max(end_col).alias("__last"), F.min(start_col).alias("__first"))
    along = Window.orderBy("__month")
    months = months.select(
        F.col("__month").alias("__m"),
        F.max("__last").over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("__reach"),
        F.lead("__first").over(along).alias("__following"))
    inside = Window.partitionBy("__month").orderBy(start_col, key)
    reach = F.greatest(F.col("__reach"), F.max(end_col).over(
        inside.rowsBetween(Window.unboundedPreceding, -1)))
    following = F.coalesce(F.lead(start_col).over(inside), F.col("__following"))
    meets = (reach >= start) | (following <= end) if inclusive else (reach > start) | (following < end)
    out = rows.join(months, F.col("__month") == F.col("__m")).withColumn("__meets", meets)
    return out.where("__meets").select(*intervals.columns)
