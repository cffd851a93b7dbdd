"""Text lists of ids: split, look up, edit and collapse.

One plan at any size: names depend on nothing but the list text, so the distinct list
texts are exploded with their positions, joined to the dimension and regrouped, and the
result is joined back on the text. Whether a side of these joins is broadcast is left to the
planner, which knows its size. Callers with many rows first reduce them to the distinct
combinations they hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_ids(col, sep: str = ",") -> Column:
    """``'1, 5'`` -> ``[1, 5]``; elements trimmed and safely cast (bad -> NULL).
    A NULL list stays NULL."""
    return F.transform(F.split(_c(col), sep), lambda x: F.trim(x).try_cast("bigint"))


def list_size(col, sep: str = ",") -> Column:
    """Number of elements, 0 for a NULL list (lateral COUNT over a split).
    Explicit NULL test: with ANSI off, legacy ``size(NULL)`` is -1."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(0)).otherwise(F.size(F.split(c, sep)))


def with_names(df: DataFrame, ids_col: str, dim: DataFrame, dim_key: str, dim_value: str,
               out: str) -> DataFrame:
    """Add ``out``: the names of the CSV ids in ``ids_col``, in list order
    (unknown ids give NULL elements, a NULL list gives NULL).

    A join in every respect: an id that the dimension holds twice gives both
    names (in binary order), a NULL id in the dimension matches nothing, ids
    are 64-bit. A very common list is one hot join key, which AQE's skew join
    splits on the row side."""
    lists_ = df.select(F.col(ids_col).alias("__list")).where(F.col("__list").isNotNull()).distinct()
    parts = lists_.select("__list", F.posexplode(split_ids("__list")).alias("__pos", "__id"))
    names = dim.select(F.col(dim_key).cast("bigint").alias("__id"), F.col(dim_value).alias("__name"))
    arrays = (parts.join(names, "__id", "left").groupBy("__list")
              .agg(F.array_sort(F.collect_list(F.struct("__pos", "__name"))).alias("__pairs"))
              .select("__list", F.transform("__pairs", lambda s: s["__name"]).alias(out)))
    return df.join(arrays, df[ids_col] == arrays["__list"], "left").drop("__list")


def with_all_names(df: DataFrame, lists: dict[str, str], dim: DataFrame, dim_key: str,
                   dim_value: str) -> DataFrame:
    """Add the names of several CSV lists at once (``lists``: new column -> list column), as
    :func:`with_names` does for one. ``df`` is read once: the entries of all its lists are exploded
    together, looked up in one join and put together again by the row itself, so rows must differ
    (a frame of distinct combinations)."""
    def entries(out: str, col: str) -> Column:
        return F.transform(split_ids(col), lambda x, i: F.struct(F.lit(out).alias("list"), i.alias("pos"), x.alias("id")))

    none = F.array().cast("array<struct<list:string,pos:int,id:bigint>>")
    every = F.concat(*[F.coalesce(entries(out, c), none) for out, c in lists.items()])
    names = dim.select(F.col(dim_key).cast("bigint").alias("__id"), F.col(dim_value).alias("__name"))
    looked = (df.withColumn("__e", F.explode_outer(every))
              .join(names, F.col("__e.id") == F.col("__id"), "left"))
    found = F.when(F.col("__e").isNotNull(), F.struct("__e.list", "__e.pos", F.col("__name").alias("name")))
    rows = looked.groupBy(*df.columns).agg(F.array_sort(F.collect_list(found)).alias("__found"))

    def of(out: str) -> Column:
        return F.transform(F.filter("__found", lambda s: s["list"] == out), lambda s: s["name"])

    return rows.withColumns({out: F.when(F.col(c).isNotNull(), of(out)) for out, c in lists.items()}).drop("__found")


def join_names(names: Column, sep: str = ", ") -> Column:
    """STRING_AGG semantics: NULL elements are skipped and a list with no
    non-NULL element gives NULL (not '')."""
    kept = F.filter(names, lambda x: x.isNotNull())
    return F.when(F.size(kept) > 0, F.array_join(kept, sep))


def case_insensitive_sort(arr: Column) -> Column:
    """Alphabetical order ignoring case, then binary order for ties:
    ``Bacon, BBQ Sauce, Beef``. Sorts (lower(x), x) structs with the built-in
    comparator instead of a comparator lambda."""
    keyed = F.transform(arr, lambda x: F.struct(F.lower(x).alias("k"), x.alias("v")))
    return F.transform(F.array_sort(keyed), lambda s: s["v"])


def edit_list(base: Column, removed: Column, added: Column) -> Column:
    """``base`` minus every element of ``removed`` (NULL-safe anti join), plus
    ``added`` (bag union); NULL elements dropped.

    Pass plain column references: an array captured inside a lambda is
    evaluated once per element, so callers first project the three arrays as
    columns (see ``edit_lists``)."""
    empty = F.array().cast("array<string>")
    base_nn = F.coalesce(base, empty)
    # NULL-safe NOT IN: a NULL element in ``removed`` makes array_contains
    # NULL for non-members, which must keep the row (the NULL guard).
    kept = F.when(F.size(removed) <= 0, base_nn).otherwise(
        F.filter(base_nn, lambda x: F.coalesce(~F.array_contains(removed, x), F.lit(True))))
    return F.array_compact(F.concat(kept, F.coalesce(added, empty)))


def edit_lists(df: DataFrame, base: Column, removed: Column, added: Column,
               out: str) -> DataFrame:
    """Project ``base``, ``removed`` (NULL-free) and ``added`` once, then edit.
    ``removed`` is referenced twice in the edit (size test and lambda), which
    keeps the optimizer from inlining it into the lambda."""
    empty = F.array().cast("array<string>")
    staged = df.withColumns({
        "__base": F.array_compact(F.coalesce(base, empty)),
        "__removed": F.coalesce(F.array_compact(removed), empty),
        "__added": F.array_compact(F.coalesce(added, empty))})
    return staged.withColumn(out, edit_list(F.col("__base"), F.col("__removed"),
                                            F.col("__added"))) \
        .drop("__base", "__removed", "__added")


def mark_repeats(items: Column, times: int = 2, prefix_all: bool = False) -> Column:
    """Distinct items, prefixed ``'2x'`` when they occur exactly ``times`` times
    (``prefix_all`` writes ``'Nx'`` for any count above one). Occurrences are
    counted with the built-in ``array_remove`` (no nested lambda)."""
    total = F.size(items)

    def label(x):
        n = total - F.size(F.array_remove(items, x))
        if prefix_all:
            return F.when(n > 1, F.concat(n.cast("string"), F.lit("x"), x)).otherwise(x)
        return F.when(n == times, F.concat(F.lit(f"{times}x"), x)).otherwise(x)
    return F.transform(F.array_distinct(items), label)


def explode_list(df: DataFrame, col: str, dim: DataFrame, dim_key: str, dim_value: str,
                 out: str, keep_empty: bool = False, sep: str = ",") -> DataFrame:
    """One row per list element with its looked-up name (CROSS APPLY split, or
    OUTER APPLY with ``keep_empty``: NULL lists keep one row with NULL)."""
    gen = F.explode_outer if keep_empty else F.explode
    e = df.withColumn("__id", gen(F.split(F.col(col), sep)))
    e = e.withColumn("__id", F.trim(F.col("__id")).try_cast("bigint"))
    side = dim.select(F.col(dim_key).cast("bigint").alias("__k"), F.col(dim_value).alias(out))
    how = "left" if keep_empty else "inner"
    return e.join(side, e["__id"] == side["__k"], how).drop("__id", "__k")


def collapse_list(df: DataFrame, keys: list[str], value: str, out: str, sep: str = ", ",
                  order: str | None = None, case_insensitive: bool = False) -> DataFrame:
    """Ordered string aggregate per key (``listagg .. WITHIN GROUP``)."""
    v = value
    if order:
        ob = order
    elif case_insensitive:
        ob = f"lower({v}), {v}"
    else:
        ob = v
    agg = F.expr(f"listagg({v}, '{sep}') WITHIN GROUP (ORDER BY {ob})")
    return df.groupBy(*keys).agg(agg.alias(out))
