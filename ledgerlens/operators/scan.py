"""Running totals over whole numbers, without a window that holds a whole key.

``sum(x) OVER (PARTITION BY key ORDER BY place)`` sorts a key in one task, and without a key
the whole table. Here the places are read as digits of 16 bits: totals are taken per place
without its last digit, without its last two, and without its last three (partial aggregation
each time), then carried down again. Each window runs inside one parent, so it holds at most
65,536 rows whatever the places are: dense numbers, or ids spread over all 64 bits. The depth is
fixed, nothing is sampled, and nothing runs while the plan is built.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits of a digit, and levels of totals above the places.
DIGIT, LEVELS = 16, 3

#: Name of a fold: its aggregate, and how two results are put together.
FOLDS = {"sum": (F.sum, lambda a, b: a + b), "xor": (F.bit_xor, lambda a, b: a.bitwiseXOR(b))}


def same(left: list[Column], right: list[Column]) -> Column:
    """Null-safe equality of two lists of columns (true for empty lists)."""
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in zip(left, right, strict=True)], F.lit(True))


def _inside(keys: list[str], place: str, top: bool) -> Window:
    parent = [] if top else [F.shiftright(place, DIGIT)]
    return (Window.partitionBy(*keys, *parent).orderBy(F.col(place).asc_nulls_first())
            .rowsBetween(Window.unboundedPreceding, -1))


def totals_before(df: DataFrame, keys: list[str], place: str,
                  folds: dict[str, tuple[str, str]]) -> DataFrame:
    """``df`` with a column for each of ``folds`` (new column -> kind of fold, source column):
    the fold of the source over the rows of the same ``keys`` with a smaller ``place`` (a long,
    NULL first), 0 where there are none. ``df`` holds a row per keys and place; its sources are
    longs without NULLs."""
    names = [f"__k{i}" for i in range(len(keys))]
    level = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)],
                      F.col(place).alias("__at"), *[F.col(s).alias(f"__{o}") for o, (_, s) in folds.items()])
    levels = []
    for _ in range(LEVELS):
        level = level.groupBy(*names, F.shiftright("__at", DIGIT).alias("__at")) \
            .agg(*[FOLDS[kind][0](f"__{o}").alias(f"__{o}") for o, (kind, _) in folds.items()])
        levels.append(level)
    above = None
    for n, level in reversed(list(enumerate(levels))):
        window = _inside(names, "__at", n == LEVELS - 1)
        here = level.select(*names, "__at", *[
            F.coalesce(FOLDS[kind][0](f"__{o}").over(window), F.lit(0)).alias(f"__{o}")
            for o, (kind, _) in folds.items()])
        above = here if above is None else _carried(here, above, names, "__at", folds)
    here = df.withColumns({f"__{o}": F.coalesce(FOLDS[kind][0](s).over(_inside(keys, place, False)), F.lit(0))
                           for o, (kind, s) in folds.items()})
    out = _carried(here, above, keys, place, folds)
    return out.withColumnsRenamed({f"__{o}": o for o in folds})


def _carried(here: DataFrame, above: DataFrame, keys: list[str], place: str, folds) -> DataFrame:
    """Totals inside a parent, with what stands before the parent put to them."""
    to = above.select(*[F.col(c).alias(f"__up_{c}") for c in above.columns])
    up = [c for c in to.columns if c.startswith("__up___k")] + ["__up___at"]
    on = same([*[F.col(k) for k in keys], F.shiftright(place, DIGIT)], [F.col(c) for c in up])
    joined = here.join(to, on)
    return joined.withColumns({f"__{o}": FOLDS[kind][1](F.col(f"__{o}"), F.col(f"__up___{o}"))
                               for o, (kind, _) in folds.items()}).select(*here.columns)
