"""Table contracts as data-quality checks.

Parquet tables do not enforce keys or CHECK constraints, so each constraint
becomes a distributed check returning its violations; ``contract_report``
folds any number of checks into one (check, violations) frame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values occurring more than once (primary-key uniqueness)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def any_null(cols: list[str]):
    """Condition: a column that must not be NULL is."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def outside(col: str, lo, hi):
    """Condition: ``col BETWEEN lo AND hi`` fails; NULL passes, as in SQL CHECK."""
    return ~F.col(col).between(lo, hi)


def null_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.where(any_null(cols))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent (foreign key)."""
    p = parent.select(F.col(parent_key).alias("__pk")).distinct()
    c = child.where(F.col(child_key).isNotNull())
    return c.join(p, c[child_key] == p["__pk"], "left_anti")


def out_of_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    return df.where(outside(col, lo, hi))


def same_key_same_date(df: DataFrame, key: str, date_col: str) -> DataFrame:
    """Duplicate change events: more than one row per (key, date)."""
    return duplicate_keys(df, [key, date_col])


def out_of_order(df: DataFrame, key: str, date_col: str, arrival_col: str, block: int = 100_000) -> DataFrame:
    """Changes that arrived after a later-dated change of the same key.

    The running maximum of the dates by arrival (a whole number) is taken inside blocks of
    ``block`` arrivals of a key, and over one row per block for what came before, so a key
    with a third of the rows is spread over its blocks."""
    rows = df.withColumn("__block", F.floor(F.col(arrival_col) / F.lit(block)))
    blocks = rows.groupBy(F.col(key).alias("__key"), F.col("__block").alias("__at")) \
        .agg(F.max(date_col).alias("__max"))
    past = (Window.unboundedPreceding, -1)
    blocks = blocks.select("__key", "__at", F.max("__max").over(
        Window.partitionBy("__key").orderBy("__at").rowsBetween(*past)).alias("__earlier"))
    inside = F.max(date_col).over(Window.partitionBy(key, "__block").orderBy(arrival_col).rowsBetween(*past))
    met = F.col(key).eqNullSafe(F.col("__key")) & F.col("__block").eqNullSafe(F.col("__at"))
    return (rows.join(blocks, met).withColumn("__prev", F.greatest("__earlier", inside))
            .where(F.col("__prev") > F.col(date_col)).select(*df.columns))


def row_checks(df: DataFrame, violated: dict) -> DataFrame:
    """Violations of conditions on single rows of one table, counted in one scan:
    ``check_name, violations``."""
    counts = df.agg(*[F.count_if(c).alias(name) for name, c in violated.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("violations"))
                      for n in violated])
    return counts.select(F.explode(pairs).alias("c")).select("c.check_name", "c.violations")


def one_pass_report(tables: dict[str, DataFrame], primary: dict[str, tuple[str, str]],
                    foreign: dict[str, tuple[str, str, str, str]],
                    rows: dict[str, tuple[str, object]]) -> DataFrame:
    """``check_name, violations`` of a whole contract, reading each table once with one shuffle
    (S7 to S10, X7).

    ``primary`` names key columns (table, column): key values that occur more than once. ``foreign``
    names references (child, column, parent, column): child rows whose non-NULL key has no
    parent. ``rows`` names conditions (table, violation) on single rows.

    Every row becomes one row per key column of its table that a check needs, with a 1 in that
    column's slot; the slots are added up by key value (partially before the shuffle), so a
    value's number of rows in each column stands in one place. Violations of single rows ride
    along on a row's first copy."""
    domain = {}  # columns that are compared share a domain
    for t, c in primary.values():
        domain.setdefault((t, c), f"{t}.{c}")
    for child, c, parent, k in foreign.values():
        domain.setdefault((parent, k), f"{parent}.{k}")
    for child, c, parent, k in foreign.values():
        old, new = domain.get((child, c)), domain[(parent, k)]
        domain = {x: new if d == old else d for x, d in domain.items()} if old else domain
        domain[(child, c)] = new
    slots = {column: f"__s{i}" for i, column in enumerate(domain)}
    frames = []
    for name, df in tables.items():
        mine = [(column, d) for column, d in domain.items() if column[0] == name]
        flags = {check: cond for check, (t, cond) in rows.items() if t == name}
        copies = [F.struct(
            F.lit(d).alias("domain"), F.col(column[1]).cast("string").alias("key"),
            *[F.lit(int(s == slots[column])).cast("bigint").alias(s) for s in slots.values()],
            *[(F.when(flags[check], 1).otherwise(0) if i == 0 and check in flags else F.lit(0)).cast("bigint")
              .alias(f"__r_{check}") for check in rows])
            for i, (column, d) in enumerate(mine or [((name, next(iter(df.columns))), "")])]
        frames.append(df.select(F.explode(F.array(*copies)).alias("r")).select("r.*"))
    counted = [*slots.values(), *[f"__r_{check}" for check in rows]]
    keys = reduce(DataFrame.unionByName, frames).groupBy("domain", "key").agg(*[F.sum(c).alias(c) for c in counted])

    def of(column):
        return F.col(slots[column])

    checks = {name: F.count_if(of(column) > 1) for name, column in primary.items()}
    for name, (child, c, parent, k) in foreign.items():
        alone = F.col("key").isNotNull() & (of((parent, k)) == 0)
        checks[name] = F.coalesce(F.sum(F.when(alone, of((child, c)))), F.lit(0))
    checks |= {name: F.coalesce(F.sum(f"__r_{name}"), F.lit(0)) for name in rows}
    totals = keys.agg(*[c.cast("bigint").alias(name) for name, c in checks.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("violations")) for n in checks])
    return totals.select(F.explode(pairs).alias("c")).select("c.check_name", "c.violations")


def contract_report(checks: dict[str, DataFrame], *counted: DataFrame) -> DataFrame:
    """One row per check with its violation count: frames of violations by name, and reports
    of :func:`row_checks`."""
    frames = [df.agg(F.count(F.lit(1)).alias("violations"))
              .select(F.lit(name).alias("check_name"), "violations")
              for name, df in checks.items()]
    return reduce(DataFrame.unionByName, [*frames, *counted])


def with_default_now(df: DataFrame, col: str) -> DataFrame:
    """DEFAULT current timestamp on write: fill a missing value with now()."""
    return df.withColumn(col, F.coalesce(F.col(col), F.current_timestamp().cast("timestamp_ntz")))
