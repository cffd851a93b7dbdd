"""Ranking, top-k and numbering operators.

Windows are partitioned by an entity key (per-group ranks) or run over an
already-aggregated, dimension-sized frame. Top-k without ties is
``orderBy().limit(k)`` (TakeOrderedAndProject: per-partition top-k, then a
k-row merge). Rank filters let Catalyst insert WindowGroupLimit so each map
task keeps only its leading rows before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, order: list[Column], offset: int = 0) -> DataFrame:
    """``k`` rows by a total order (callers add a tie-breaker), after ``offset`` rows
    (OFFSET .. FETCH)."""
    ordered = df.orderBy(*order)
    return (ordered.offset(offset) if offset else ordered).limit(k)


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int = 1,
                  ties: bool = True, rank_col: str | None = None) -> DataFrame:
    """Rows ranked ``<= k`` inside each group; ``ties=True`` uses RANK (keeps
    ties), otherwise ROW_NUMBER with the given total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    fn = F.rank() if ties else F.row_number()
    name = rank_col or "__rank"
    out = df.withColumn(name, fn.over(w)).where(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def dense_rank_by_value(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """``DENSE_RANK() OVER (PARTITION BY keys ORDER BY value)`` for every row,
    skew-safe: the rank is computed over the distinct (keys, value) pairs (a
    hot key holds at most one row per distinct value there) and joined back on
    (keys, value), which spreads a hot key over its values; AQE's skew join
    splits any value that is itself hot."""
    distinct = df.select(*keys, value).distinct()
    ranked = distinct.withColumn(name, F.dense_rank().over(
        Window.partitionBy(*keys).orderBy(value)))
    return df.join(ranked, [*keys, value], "left")


def top_k_with_ties(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """Global top-k keeping ties (``TOP k WITH TIES``). Meant for aggregated
    frames (one row per item); the global window then sorts a small frame."""
    w = Window.orderBy(*order)
    return df.withColumn("__rank", F.rank().over(w)).where(F.col("__rank") <= k).drop("__rank")


def share_of_total(df: DataFrame, keys: list[str], value: str, total_keys: list[str],
                   name: str, scale: int = 2) -> DataFrame:
    """Percent of ``value`` per ``keys`` within its ``total_keys`` partition.

    Aggregates first, then takes the partition total over the aggregated rows,
    so the window never sees the fact rows."""
    from ..functions import ratio
    agg = df.groupBy(*keys).agg(F.sum(value).alias("__part"))
    tot = F.sum("__part").over(Window.partitionBy(*total_keys))
    return (agg.withColumn("__total", tot)
            .select(*keys, ratio(F.col("__part"), F.col("__total"), scale, 100).alias(name)))


def growth(df: DataFrame, order_col: str, value: str, name: str, scale: int = 1) -> DataFrame:
    """Period-over-period percent change of an aggregated series; the first
    period gets 0. The series is one row per period (already aggregated)."""
    from ..functions import ratio
    prev = F.lag(value).over(Window.orderBy(order_col))
    pct = ratio(F.col(value) - prev, prev, scale, 100)
    return df.withColumn(name, F.coalesce(pct, F.lit(0).cast(f"decimal(18,{scale})")))
