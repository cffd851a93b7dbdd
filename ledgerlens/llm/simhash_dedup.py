"""SimHash near-dedup (operator 5): BK-trees over shards of fingerprints.

A text's fingerprint is the bitwise majority of the 64-bit hashes of its word shingles. Two
texts are linked if their fingerprints differ in at most ``radius`` bits; documents that
links connect form a component.

Distinct fingerprints are dealt to shards by the pigeonhole principle: of ``radius + 2``
blocks of bits at least two are equal in any linked pair, so every pair meets in the shard
of such two blocks. Each shard is searched with a BK-tree, whose children are keyed by the
Hamming distance to the parent, following only the edges within the radius. The trees of all
shards grow with the corpus, so they are not broadcast to every executor: a shard's
fingerprints are shuffled together and its tree lives in one task while it is searched.
A shard emits links that join two of its groups only, never all pairs of a group.

Null texts and texts without words have fingerprint zero and are linked like others; repeated
rows share a fingerprint; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import sheltered, stored
from .graph import connected_components

#: Shingles whose bits are counted at a time.
_BLOCK = 1 << 14


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """Majority bits of the XXH64 of all shingles of ``words`` words of ``text``."""
    import xxhash

    norm = b" ".join((text or "").encode("utf-8", "replace").lower().split())
    if not norm:
        return 0
    gaps = np.flatnonzero(np.frombuffer(norm, np.uint8) == 32)
    starts = np.concatenate([[0], gaps + 1])
    ends = np.concatenate([gaps, [len(norm)]])[min(words - 1, len(gaps)):]
    digest, n = xxhash.xxh64_intdigest, len(ends)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, _BLOCK):
        spans = zip(starts[i:i + _BLOCK].tolist(), ends[i:i + _BLOCK].tolist())
        part = [digest(norm[a:b], seed) for a, b in spans]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a long) and ``text_hash`` of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            found = np.array([fingerprint(texts[i].as_py(), words, seed) for i in range(len(texts))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64)), batch.column(2)],
                                             names=["doc_id", "fp", "text_hash"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, fp long, text_hash long")


class BKTree:
    """A metric tree over 64-bit values under the Hamming distance."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        new, at = len(self.values) - 1, 0
        while at != new:
            at = self.children[at].setdefault((self.values[at] ^ value).bit_count(), new)

    def within(self, value: int, radius: int) -> list[int]:
        """Positions of the values at most ``radius`` bits away."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            distance = (self.values[at] ^ value).bit_count()
            if distance <= radius:
                found.append(at)
            children = self.children[at]
            todo += [children[d] for d in range(distance - radius, distance + radius + 1) if d in children]
        return found


class _Shard:
    """The tree of a shard, and which of its values are linked already."""

    def __init__(self, radius: int):
        self.radius, self.tree, self.parent = radius, BKTree(), []

    def _root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def add(self, value: int) -> list[int]:
        """Insert ``value``; values that it is linked to, one of each group known so far."""
        found = self.tree.within(value, self.radius)
        self.tree.add(value)
        new, out = len(self.parent), []
        self.parent.append(new)
        for x in found:
            if (root := self._root(x)) != self._root(new):
                self.parent[root] = self._root(new)
                out.append(self.tree.values[x])
        return out


def _block_masks(radius: int) -> list[int]:
    edges = [round(64 * k / (radius + 2)) for k in range(radius + 3)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [a | b for a, b in combinations(blocks, 2)]


def linked(values: DataFrame, radius: int = 2) -> DataFrame:
    """Links ``a, b`` between distinct values (column ``fp``) that connect every two values at
    most ``radius`` bits apart, directly or through others."""
    signed = [m - (1 << 64) if m >> 63 else m for m in _block_masks(radius)]
    shards = F.array(*[F.struct(F.lit(k).alias("which"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("part"))
                       for k, m in enumerate(signed)])
    dealt = values.select("fp", F.explode(shards).alias("s")).select("s.which", "s.part", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, shard, first = None, None, 0
        for batch in batches:
            out = []
            which, part, fps = (c.to_pylist() for c in batch.columns)
            for key, value in zip(zip(which, part), fps):
                if key != last:
                    last, shard, first = key, None, value
                    continue
                if shard is None:  # most shards hold one value and need no tree
                    shard = _Shard(radius)
                    shard.add(first & 0xFFFFFFFFFFFFFFFF)
                out += [(value, x - (1 << 64) if x >> 63 else x)
                        for x in shard.add(value & 0xFFFFFFFFFFFFFFFF)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())],
                names=["a", "b"])

    partitions = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (dealt.repartition(partitions, "which", "part").sortWithinPartitions("which", "part", "fp")
            .mapInArrow(run, "a long, b long").distinct())


def _components(prints: DataFrame, radius: int) -> DataFrame:
    """``value`` (a fingerprint) and ``first`` (of the first row of its component: whether the id
    is null, id, hash of the text) of every fingerprint."""
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    values = stored(prints.groupBy("fp").agg(F.min(row).alias("first")), "values")
    roots = connected_components(linked(values.select("fp"), radius))
    values = values.join(roots, F.col("fp") == F.col("node"), "left") \
        .select("fp", "first", F.coalesce("root", "fp").alias("root"))
    firsts = values.groupBy("root").agg(F.min("first").alias("first"))
    return values.select(F.col("fp").alias("value"), "root").join(firsts, "root").select("value", "first")


def near_duplicates(docs: DataFrame, radius: int = 2, words: int = 3, seed: int = 42,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` (smallest id of the
    component) of each row."""
    prints = stored(fingerprints(docs, words, seed, id_col, text_col), "fingerprints")
    named = _components(prints, radius)
    return prints.join(named, F.col("fp") == F.col("value")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"))


def keep_one(docs: DataFrame, radius: int = 2, words: int = 3, seed: int = 42,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one of the smallest id (null ids last), and
    of the smallest hash of the text if ids repeat."""
    docs, back = sheltered(docs, id_col, text_col)
    prints = stored(fingerprints(docs, words, seed, id_col, text_col), "fingerprints")
    kept = _components(prints, radius).select("first.doc_id", "first.text_hash").distinct() \
        .select(F.col("doc_id").alias("__kept"), F.col("text_hash").alias("__kept_hash"))
    rows = docs.withColumn("__hash", F.xxhash64(F.col(text_col).cast("string")))
    met = F.col(id_col).eqNullSafe(F.col("__kept")) & (F.col("__hash") == F.col("__kept_hash"))
    same = Window.partitionBy(id_col, "__hash").orderBy(F.lit(1))  # rows equal in id and text
    return back(rows.join(kept, met, "left_semi").withColumn("__n", F.row_number().over(same))
                .where(F.col("__n") == 1))
