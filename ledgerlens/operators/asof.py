"""As-of joins against a per-key date (J5-J8) and role self-joins.

The date that qualifies for a key is found by aggregation (partial on the map side, one row
per key and date before the join), then joined back on (key, date). So a key that holds a
third of the rows never meets in one task: its rows are spread over their dates, and AQE's
skew join may split any of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_before(facts: DataFrame, anchors: DataFrame, key: str, fact_date: str,
                anchor_date: str, on_or_after: bool = False) -> DataFrame:
    """Facts strictly before (or on/after) the key's anchor date."""
    cond = facts[key] == anchors[key]
    cond = cond & ((facts[fact_date] >= anchors[anchor_date]) if on_or_after
                   else (facts[fact_date] < anchors[anchor_date]))
    return facts.join(anchors, cond).drop(anchors[key])


def _asof(facts, anchors, key, fact_date, anchor_date, on_or_after):
    dates = facts.select(key, fact_date).distinct()
    pick = F.min if on_or_after else F.max
    best = (join_before(dates, anchors.select(key, anchor_date), key, fact_date, anchor_date, on_or_after)
            .groupBy(key, anchor_date).agg(pick(fact_date).alias(fact_date)))
    return facts.join(best, [key, fact_date])


def asof_first(facts: DataFrame, anchors: DataFrame, key: str, fact_date: str,
               anchor_date: str) -> DataFrame:
    """Earliest facts on or after the anchor date (ties kept), with the anchor date."""
    return _asof(facts, anchors, key, fact_date, anchor_date, True)


def asof_last(facts: DataFrame, anchors: DataFrame, key: str, fact_date: str,
              anchor_date: str) -> DataFrame:
    """Latest facts strictly before the anchor date (ties kept), with the anchor date."""
    return _asof(facts, anchors, key, fact_date, anchor_date, False)


def earliest_per_key(rows: DataFrame, key: str, order: list) -> DataFrame:
    """The first row of each key by ``order`` (sortable expressions), by partial aggregation."""
    others = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("__row")) \
        .select(key, *[F.col(f"__row.{c}").alias(c) for c in others])


def snapshot_at(changes: DataFrame, key: str, date_col: str, before, tie_break: list) -> DataFrame:
    """Latest state per key among changes dated before ``before`` (exclusive); of changes on one
    day the first by ``tie_break``.

    The filter stays before the choice (an as-of cutoff must not be swapped with it)."""
    latest_first = -F.unix_date(F.col(date_col))
    return earliest_per_key(changes.where(F.col(date_col) < F.lit(before)), key,
                            [latest_first.alias("__late"), *tie_break])


def role_join(log: DataFrame, key: str, date_col: str, first_filter, second_filter,
              first_name: str, second_name: str, later_only: bool = False) -> DataFrame:
    """The key's rows in a second role with its first date in a first role (e.g. trial start x
    annual start): one row per second-role row, however many first-role rows there are.
    ``later_only`` keeps second > first."""
    a = log.where(first_filter).groupBy(key).agg(F.min(date_col).alias(first_name))
    b = log.where(second_filter).select(F.col(key), F.col(date_col).alias(second_name))
    j = b.join(a, key).select(key, first_name, second_name)
    return j.where(F.col(second_name) > F.col(first_name)) if later_only else j
