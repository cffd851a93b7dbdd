"""Consecutive surrogate keys over a total order, without a one-partition window.

``row_number() OVER (ORDER BY ..)`` with no partition sorts everything in one task. Here the
leading order column, a whole number, is cut at fixed points into buckets: a row's bucket
depends on nothing but its value, so any task, and any repeated one, puts it in the same
place. One aggregate counts rows per bucket; :mod:`scan` turns the counts into offsets by a
tree of fixed depth, so ids spread over all 64 bits cost no larger window than dense ones; a
row number inside the bucket completes the key. Nothing is stored and no range is sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scan import same, totals_before


def surrogate_key(df: DataFrame, leading: str, order: list[Column], name: str = "rownum",
                  keys: list[str] | None = None, bits: int = 12) -> DataFrame:
    """Add ``name``: 1, 2, .. by ``leading`` (a whole number, NULL first) and then ``order``,
    over the table or, with ``keys``, for each of their values.

    ``2 ** bits`` values of ``leading`` share a bucket."""
    keys = keys or []
    rows = df.withColumn("__bucket", F.shiftright(F.col(leading).cast("bigint"), bits))
    counts = rows.groupBy(*keys, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    skipped = totals_before(counts, keys, "__bucket", {"__skip": ("sum", "__n")})
    offsets = skipped.select(*[F.col(k).alias(f"__of_{k}") for k in keys], F.col("__bucket").alias("__b"), "__skip")
    met = same([F.col(c) for c in (*keys, "__bucket")], [F.col(c) for c in (*(f"__of_{k}" for k in keys), "__b")])
    within = Window.partitionBy(*keys, "__bucket").orderBy(F.col(leading).asc_nulls_first(), *order)
    keyed = rows.withColumn("__row", F.row_number().over(within)).join(offsets, met)
    return keyed.withColumn(name, (F.col("__skip") + F.col("__row")).cast("bigint")).select(*df.columns, name)
