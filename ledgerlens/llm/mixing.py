"""Mixing sources to target weights (operator 6) by capped water-filling.

A budget of words is shared among sources by weight. A source's target stops at
``max_epochs`` times its size; the excess goes to the others by weight until no target
is above. The fixed point is a common water level: target = min(cap, weight * level), and
the sources that stop at their cap are the first ones in the order of cap / weight. It is
found exactly, in integers, with running sums over one row per source.

A target is taken as whole repetitions of every document and one more repetition of a
seeded sample: the documents that come first in the order of a seeded hash of the id, until
the words still due are reached; the last one of them is taken in part, so a source misses
its target by less than a word. Running sums go over hash buckets first, so no task holds a
whole source.

Null texts have size 0, a null source is a source of its own and comes last, sources of
size 0 get target 0, repeated rows are documents of their own, an empty table gives an
empty mix. Columns other than the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of the seeded hash that name a bucket.
BUCKET_DIGITS = 3


def document_sizes(docs: DataFrame, seed: int, id_col: str = "doc_id", source_col: str = "source",
                   text_col: str = "text") -> DataFrame:
    """Each row's id, source, size in words and seeded sampling key."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
        .alias("key"))


def source_targets(sizes: DataFrame, weights: Sequence[int], budget: Fraction,
                   max_epochs: int) -> DataFrame:
    """Per source (columns ``source``, ``source_size``): target, whole repetitions of all
    documents (``whole``) and the words of the partial repetition (``part``)."""
    big = "decimal(38,0)"
    order = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    cycle = F.array(*[F.lit(w) for w in weights])
    s = (sizes
         .withColumn("position", F.row_number().over(order))
         .withColumn("weight", cycle[(F.col("position") - 1) % len(weights)].cast(big))
         .withColumn("cap", (F.lit(max_epochs) * F.col("source_size")).cast(big))
         .withColumn("due", F.lit(budget.numerator) * F.sum("source_size").over(every).cast(big)))
    # The level where a source just reaches its cap holds that much water in all.
    full = Window.orderBy(F.col("cap") / F.col("weight"), "position")
    s = (s
         .withColumn("caps_before", F.coalesce(
             F.sum("cap").over(full.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast(big))
         .withColumn("weight_rest", F.sum("weight").over(
             full.rowsBetween(0, Window.unboundedFollowing)).cast(big))
         .withColumn("capped", F.lit(budget.denominator) * (
             F.col("cap") * F.col("weight_rest") + F.col("caps_before") * F.col("weight"))
             <= F.col("due") * F.col("weight")))
    s = (s
         .withColumn("water", (F.col("due") - F.lit(budget.denominator) * F.coalesce(
             F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), F.lit(0))).cast(big))
         .withColumn("open_weight", F.sum(F.when(~F.col("capped"), F.col("weight"))).over(every)))
    above = (F.col("weight") * F.col("water")).cast(big)
    below = (F.lit(budget.denominator) * F.col("open_weight")).cast(big)
    s = (s.withColumn("above", F.when(F.col("capped"), F.col("cap")).otherwise(above))
         .withColumn("below", F.when(F.col("capped"), F.lit(1)).otherwise(below).cast(big)))
    whole = F.expr("CASE WHEN source_size = 0 THEN 0 ELSE above DIV (below * source_size) END")
    return (s.withColumn("whole", whole)
            .withColumn("part", F.expr("(above - whole * below * source_size) DIV below"))
            .withColumn("target", F.col("above").cast("double") / F.col("below").cast("double"))
            .select("source", "source_size", "target", "whole", "part"))


def mix_sources(docs: DataFrame, weights: Sequence[int] = (3, 1, 2),
                budget: Fraction = Fraction(3, 2), max_epochs: int = 2, seed: int = 42,
                id_col: str = "doc_id", source_col: str = "source",
                text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, whole, sampled,
    taken``: whole repetitions, words of the sampled one, and words taken in all.

    ``weights`` are given to the sources in code point order, repeating; ``budget`` is the
    share of all words to take; no document is taken more than ``max_epochs`` times.
    """
    sizes = stored(document_sizes(docs, seed, id_col, source_col, text_col), "sizes") \
        .withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    buckets = sizes.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    targets = source_targets(buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")),
                             weights, budget, max_epochs)
    before = Window.partitionBy("source").orderBy("bucket") \
        .rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select(
        F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"),
        F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("size_before"))
    targets = targets.withColumnRenamed("source", "t_source")
    plan = buckets.join(targets, F.col("b_source").eqNullSafe(F.col("t_source"))).drop("t_source")
    within = Window.partitionBy("source", "bucket").orderBy("key", "size") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    due = F.col("part") - (F.col("size_before") + F.col("running") - F.col("size"))
    return (sizes.withColumn("running", F.sum("size").over(within))
            .join(plan, F.col("source").eqNullSafe(F.col("b_source"))
                  & (F.col("bucket") == F.col("b_bucket")))
            .withColumn("sampled", F.greatest(F.lit(0), F.least(F.col("size"), due)).cast("long"))
            .select("doc_id", "source", "size", "source_size", "target", F.col("whole").cast("int"),
                    "sampled", (F.col("size") * F.col("whole") + F.col("sampled")).cast("long")
                    .alias("taken")))
