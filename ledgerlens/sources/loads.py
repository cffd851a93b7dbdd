"""Loads of rows into a typed table with a key, each one commit.

A load's rows are checked, and the good and the rejected ones become one new version of the table
(:mod:`versions`), so a crash leaves either nothing or the whole load. A load has a name and a
number; run again, it changes nothing. New keys are compared with few of the loads held: each
load keeps a Bloom filter of its keys as bitmaps, four bits for each key, in pieces of 32,768
bits, joined piece by piece; only the rows of loads whose filter has all four bits of some new key
are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sinks import marked_rows, with_held
from .versions import VersionedTable

#: Bits set for each key, bits of a filter for each key, and bits of a piece (a fixed value of
#: Spark's bitmap functions).
HASHES, BITS_PER_KEY, PIECE = 4, 16, 32_768


class LoadedTable:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: list[str]):
        self.spark, self.schema, self.key = spark, schema, key
        self.table = VersionedTable(spark, root, ("outcome",))

    def accepted(self) -> DataFrame:
        return self._outcome("accepted").select(*self.schema.names)

    def rejected(self) -> DataFrame:
        """Rejected rows of all loads, with the rules they break (``broken``)."""
        return self._outcome("rejected").drop("outcome")

    def _outcome(self, outcome: str) -> DataFrame:
        return self.table.read().where(F.col("outcome") == outcome)

    def load(self, df: DataFrame, load: tuple[str, int], rules: dict,
             references: dict[str, tuple[DataFrame, str]] | None = None,
             now_columns: tuple[str, ...] = ()) -> list[str]:
        """Load ``df`` as ``load`` (name, number that grows). Returns the names of the held loads
        whose rows were read to compare keys (empty if none had to be)."""
        version = self.table.current()
        if version and version.applied.get(load[0], -1) >= load[1]:
            return []
        marked = self.table.staged(marked_rows(df, self.schema, rules, self.key, references, now_columns))
        keys = marked.select(*self.key).distinct()
        n = keys.count()
        filters = [name for name in (version.beside if version else {}) if name.startswith("keys/")]
        met = self._loads_with(keys, filters, version) if filters else []
        held = None
        if met:
            paths = [p for p in version.paths if p.split("/")[0] in met and p.endswith("outcome=accepted")]
            held = self.table.of_paths(paths, version.schema).select(*self.key).distinct()
        rows = with_held(marked, self.key, held).withColumn(
            "outcome", F.when(F.size("broken") == 0, "accepted").otherwise("rejected"))
        rows = self.table.staged(rows)
        good = rows.where(F.col("outcome") == "accepted").select(*self.key)
        size = 1 << max(15, (BITS_PER_KEY * n - 1).bit_length())
        self.table.append(rows, load, lambda folder: {f"keys/{folder}": self._filter(good, size)})
        return met

    def _bits(self, size: Column) -> Column:
        return F.array(*[F.pmod(F.xxhash64(F.lit(j), *self.key), size) + 1 for j in range(HASHES)])

    def _filter(self, keys: DataFrame, size: int) -> DataFrame:
        bits = keys.select(F.explode(self._bits(F.lit(size).cast("long"))).alias("bit"))
        return bits.groupBy(F.bitmap_bucket_number("bit").alias("piece")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")) \
            .withColumn("size", F.lit(size).cast("long"))

    def _loads_with(self, keys: DataFrame, filters: list[str], version) -> list[str]:
        """Folders of loads that may hold one of ``keys``, by their filters."""
        held = reduce(DataFrame.unionByName, [
            self.table.beside(name, version).withColumn("folder", F.lit(name.split("/", 1)[1])) for name in filters])
        sizes = [r["size"] for r in held.select("size").distinct().collect()]  # powers of two: few
        asked = keys.withColumn("asked", F.explode(F.array(*[F.lit(s).cast("long") for s in sizes]))) \
            .select(F.struct(*self.key).alias("k"), "asked", F.posexplode(self._bits(F.col("asked"))).alias("hash", "bit")) \
            .select("k", "asked", F.bitmap_bucket_number("bit").alias("in"), F.bitmap_bit_position("bit").alias("at"))
        byte = F.conv(F.hex(F.substring("bits", F.expr("CAST(at DIV 8 + 1 AS INT)"), F.lit(1))), 16, 10).cast("int")
        mask = F.element_at(F.array(*[F.lit(1 << b) for b in range(8)]), F.expr("CAST(at % 8 + 1 AS INT)"))
        found = asked.join(held, (F.col("piece") == F.col("in")) & (F.col("size") == F.col("asked"))) \
            .where(byte.bitwiseAND(mask) != 0)
        whole = found.groupBy("folder", "k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == HASHES)
        return sorted(r["folder"] for r in whole.select("folder").distinct().collect())
