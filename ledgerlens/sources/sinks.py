"""Sinks and table contracts on write.

Derived tables are written with an explicit schema, Parquet, optionally
partitioned for pruning; ``load_checked`` splits a load into accepted and
rejected rows.
"""

from __future__ import annotations

import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import quality as Q
from ..session import shared_folder


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a predefined table schema (typed table, not SELECT INTO)."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the table schema: {missing}")
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: list[str] | None = None,
                schema: T.StructType | None = None) -> None:
    """CTAS / drop-and-replace (``overwrite``) or append."""
    out = conform(df, schema) if schema is not None else df
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def load_checked(df: DataFrame, path: str, rejected_path: str, schema: T.StructType, rules: dict,
                 key: list[str] | None = None, references: dict[str, tuple[DataFrame, str]] | None = None,
                 now_columns: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Load rows into a typed table: good rows are appended to ``path``, the others to
    ``rejected_path`` with the names of the rules they break (``broken``). Returns the accepted
    and the rejected rows of this load.

    ``rules`` maps names to conditions that must hold, ``key`` must be unique in the load and
    new to the table, ``references`` maps a column to a parent and its key, ``now_columns`` are
    filled with the current time where they are NULL. The input is read once: its marked rows
    are stored, and both tables are appended from there."""
    spark = df.sparkSession
    held = None
    if key:
        try:
            held = spark.read.parquet(path).select(*key).distinct()
        except AnalysisException:  # the first load
            held = None
    marked = marked_rows(df, schema, rules, key, references, now_columns)
    kept = stored(with_held(marked, key, held), "load")
    accepted = kept.where(F.size("broken") == 0).select(*schema.names)
    rejected = kept.where(F.size("broken") > 0)
    accepted.write.mode("append").parquet(path)
    rejected.write.mode("append").parquet(rejected_path)
    return accepted, rejected


def marked_rows(df: DataFrame, schema: T.StructType, rules: dict, key: list[str] | None = None,
                references: dict[str, tuple[DataFrame, str]] | None = None,
                now_columns: tuple[str, ...] = ()) -> DataFrame:
    """Rows in the table's schema with the names of the rules they break (``broken``); ``pk`` if
    their key occurs more than once among them."""
    for c in now_columns:
        df = Q.with_default_now(df, c)
    marked = conform(df, schema)
    broken = {name: ~F.coalesce(ok, F.lit(False)) for name, ok in rules.items()}
    for c, (parent, parent_key) in (references or {}).items():
        known = parent.select(F.col(parent_key).alias(f"__ref_{c}")).distinct()
        marked = marked.join(known, F.col(c) == F.col(f"__ref_{c}"), "left")
        broken[f"fk_{c}"] = F.col(c).isNotNull() & F.col(f"__ref_{c}").isNull()
    if key:
        marked = marked.withColumn("__copies", F.count(F.lit(1)).over(Window.partitionBy(*key)))
        broken["pk"] = F.col("__copies") > 1
    names = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in broken.items()]))
    return marked.select(*schema.names, names.alias("broken"))


def with_held(marked: DataFrame, key: list[str] | None, held: DataFrame | None) -> DataFrame:
    """:func:`marked_rows` with ``pk`` also where the key is among ``held`` ones."""
    if held is None:
        return marked
    joined = marked.join(held.withColumn("__held", F.lit(True)), key, "left")
    twice = F.array_union("broken", F.array(F.lit("pk")))
    return joined.select(*[c for c in marked.columns if c != "broken"],
                         F.when(F.col("__held"), twice).otherwise(F.col("broken")).alias("broken"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back (read by several later steps;
    survives executor loss)."""
    spark = df.sparkSession
    path = os.path.join(shared_folder(spark), "tables", name, uuid.uuid4().hex)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df
