"""Exact top-k search (operator 3): block-at-a-time pruning over integer vectors.

A component x becomes the integer floor(256 * x); each dimension is a term, a vector a
document, the score the integer inner product. Documents are laid out in ranges of similar
vectors, cut into blocks; a block keeps its forward index (the rows of a matrix) and each
term's largest and smallest value. The sum over terms of query times extreme value bounds
every score in the block. A query visits blocks in the order of their bounds, scores each
through its forward index, and stops when the next bound is below its k-th best score.

Blocks are packed into shards and queries into batches; Spark joins each batch with each
shard, so no task holds more than one of each, and merges the k best per query and shard.
The first look at a query's own shard gives a threshold that the other shards start from.
A row of such a join holds about ``SHARD * dimensions`` integers of two bytes; Spark sends
rows to Python in batches of at most ``spark.sql.execution.arrow.maxBytesPerBatch`` bytes.

Vectors that are null or hold null or non-finite components take no part, neither as queries
nor as candidates; an empty vector scores 0 with all. Vectors of different lengths are
compared as if filled up with zeros. Of rows that repeat a query's id only one row equal to
the query is left out. Ties go to the smaller id. Sums beyond the range of a long are held
at its ends. Null ids take no part. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Vectors of a block, blocks' vectors of a shard, queries of a batch.
BLOCK, SHARD, BATCH = 64, 8192, 1024
#: Bits of the locality key by which documents are laid out.
_KEY_BITS = 16
#: Below this all sums of doubles are exact; components are held below the other.
_EXACT, _LARGEST = float(1 << 53), float(1 << 1000)


def quantised(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, vec`` of the rows that take part; components are whole numbers as doubles."""
    x = F.col(vec_col).cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return table.where(F.col(id_col).isNotNull() & x.isNotNull() & fine).select(
        F.col(id_col).cast("long").alias("id"), x.alias("raw")) \
        .mapInArrow(_floors, "id long, vec array<double>")


def _floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        v = batch.column(1)
        scaled = np.floor(v.flatten().to_numpy(zero_copy_only=False) * 256.0)
        whole = pa.array(np.clip(scaled, -_LARGEST, _LARGEST))
        offsets = pa.array(np.concatenate([[0], np.cumsum(v.value_lengths().to_numpy())]).astype(np.int32))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, whole)],
                                         names=["id", "vec"])


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _locality(batches, width: int):
    """Adds a key that is alike for vectors of small angle: signs of fixed random sums."""
    planes = np.random.default_rng(11).standard_normal((width, _KEY_BITS))
    for batch in batches:
        m = _matrix(batch.column(1).to_numpy(zero_copy_only=False), width)
        signs = (m @ planes > 0).astype(np.int64)
        # a binary-reflected Gray code, so that neighbours in order differ in few signs
        code = np.bitwise_xor.accumulate(signs, axis=1) @ (1 << np.arange(_KEY_BITS)[::-1])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code.astype(np.int32))],
                                         names=["id", "vec", "code"])


def laid_out(vectors: DataFrame, rows: int, shards: int, width: int) -> DataFrame:
    """Vectors with their shard: equal ranges in the order of the locality key. The rows of one
    key are dealt over its range by a hash, so no shard grows with a group of like vectors."""
    keyed = vectors.mapInArrow(lambda b: _locality(b, width), "id long, vec array<double>, code int") \
        .withColumn("salt", F.xxhash64("id", "vec"))
    # where each key begins in the order of all vectors: at most 2 ** 16 rows, so broadcast
    counts = keyed.groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("code").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    place = F.col("before") + F.pmod(F.col("salt"), F.col("n"))
    return keyed.join(F.broadcast(counts), "code").select(
        "id", "vec", "code", "salt", F.least(F.floor(place * shards / max(1, rows)), F.lit(shards - 1))
        .cast("int").alias("shard"))


def _bytes(matrix: np.ndarray) -> bytes:
    """A matrix in two bytes a component if that holds it, after a byte that tells."""
    if np.abs(matrix).max(initial=0) < 32768:
        return b"h" + matrix.astype(np.int16).tobytes()
    return b"d" + matrix.tobytes()


def _from_bytes(raw: bytes, rows: int) -> np.ndarray:
    kind = np.int16 if raw[:1] == b"h" else np.float64
    found = np.frombuffer(raw, kind, offset=1).astype(np.float64)
    return found.reshape(rows, len(found) // max(1, rows))


def _packed(rows: DataFrame, key: str, name: str, width: int, size: int) -> DataFrame:
    """Groups of ``key`` in parts of at most ``size`` rows: ids and a matrix as bytes, and
    whether the first row equals the last one of the part before."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["code", "salt", "id"])
        ids, matrix, out = pdf["id"].to_numpy(np.int64), _matrix(pdf["vec"].tolist(), width), []
        for a in range(0, len(pdf), size):
            goes_on = a > 0 and ids[a] == ids[a - 1] and (matrix[a] == matrix[a - 1]).all()
            out.append((pdf[key].iloc[0], a // size, ids[a:a + size].tobytes(),
                        _bytes(matrix[a:a + size]), bool(goes_on)))
        return pd.DataFrame(out, columns=[key, "part", f"{name}_ids", f"{name}_matrix", f"{name}_goes_on"])

    return rows.groupBy(key).applyInPandas(
        run, f"{key} int, part int, {name}_ids binary, {name}_matrix binary, {name}_goes_on boolean")


def _best_of(ids: np.ndarray, scores: np.ndarray, k: int):
    if scores.dtype == object:
        order = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k]
    else:
        order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


class ShardIndex:
    """Blocks of a shard with their term extremes."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        self.ids, self.matrix = ids, matrix
        self.cuts = list(range(0, len(ids), BLOCK))
        self.most = np.stack([matrix[a:a + BLOCK].max(axis=0) for a in self.cuts])
        self.least = np.stack([matrix[a:a + BLOCK].min(axis=0) for a in self.cuts])
        self.largest = np.abs(matrix).max(initial=0)

    def search(self, query_ids, queries, k: int, floors, goes_on: bool = False):
        """Per query: ids and scores of up to k best candidates at or above its floor."""
        exact = np.abs(queries).max(initial=0) * self.largest * max(1, queries.shape[1]) < _EXACT
        with np.errstate(over="ignore", invalid="ignore"):
            bounds = np.maximum(queries, 0) @ self.most.T + np.minimum(queries, 0) @ self.least.T
            if not exact:  # room for what rounding may hide
                far = np.maximum(np.abs(self.most), np.abs(self.least))
                bounds = np.nan_to_num(bounds + np.abs(queries) @ far.T * 1e-9, nan=np.inf, posinf=np.inf)
        for q, (qid, vector, floor) in enumerate(zip(query_ids, queries, floors, strict=True)):
            ids, scores, own = np.zeros(0, np.int64), np.zeros(0), True
            for b in np.argsort(-bounds[q], kind="stable"):
                if bounds[q, b] < floor:
                    break
                a = self.cuts[b]
                rows, new = self.matrix[a:a + BLOCK], self.ids[a:a + BLOCK]
                found = rows @ vector if exact else _exact_scores(rows, vector)
                keep = found >= floor
                if own and (new == qid).any():  # the query's own row is left out, once
                    same = np.flatnonzero((new == qid) & (rows == vector).all(axis=1))
                    if len(same):
                        own = False
                        keep[same[0]] = keep[same[0]] and goes_on and a + same[0] == 0
                ids, scores = np.concatenate([ids, new[keep]]), np.concatenate([scores, found[keep]])
                if len(ids) >= k:
                    ids, scores = _best_of(ids, scores, k)
                    floor = max(floor, scores[-1])
            yield _best_of(ids, scores, k)


def _exact_scores(rows, vector) -> np.ndarray:
    """Inner products in whole numbers of any size, held within a long."""
    query = [int(x) for x in vector]
    sums = [sum(int(a) * b for a, b in zip(row, query, strict=True)) for row in rows]
    return np.array([min(max(s, -2**63), 2**63 - 1) for s in sums], dtype=object)


def _search(k: int, names: list[str]):
    """mapInArrow function over rows that hold a batch of queries and a shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(i)[r].as_py() for i, n in enumerate(names)}
                qids, dids = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["d_ids"], np.int64)
                index = ShardIndex(dids, _from_bytes(row["d_matrix"], len(dids)))
                floors = np.full(len(qids), -np.inf)
                for known in row.get("known") or []:
                    floors[known["place"]] = known["score"]
                found = list(index.search(qids, _from_bytes(row["q_matrix"], len(qids)), k, floors,
                                          row["d_goes_on"]))
                n = [len(i) for i, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(sum(n), row["batch"]), pa.int64()),
                     pa.array(np.repeat(np.arange(len(n)), n), pa.int32()), pa.array(np.repeat(qids, n)),
                     pa.array(np.concatenate([i for i, _ in found]).astype(np.int64)),
                     pa.array([int(s) for _, x in found for s in x], pa.int64())],
                    names=["batch", "place", "query_id", "vec_id", "score"])

    return run


_FOUND = "batch long, place int, query_id long, vec_id long, score long"


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("batch", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(table: DataFrame, is_query, k: int = 5, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best other rows of each row where ``is_query``
    (a condition on the column ``id``) holds."""
    vectors = stored(quantised(table, id_col, vec_col), "quantised")
    rows, width = vectors.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vec")), F.lit(0))).first()
    shard_count = max(1, -(-rows // SHARD))
    placed = stored(laid_out(vectors, rows, shard_count, width), "laid-out")
    shards = stored(_packed(placed, "shard", "d", width, 2 * SHARD).drop("part"), "shards")
    batch = F.col("home").cast("long") * (1 << 31) + F.col("part")
    queries = stored(_packed(placed.where(is_query).withColumnRenamed("shard", "home"), "home", "q", width,
                             BATCH).select("home", batch.alias("batch"), "q_ids", "q_matrix"), "queries")
    data = ["q_ids", "q_matrix", "d_ids", "d_matrix", "d_goes_on"]
    # first each query's own shard: similar vectors lie there, and its k-th score is a threshold
    near = queries.join(shards, F.col("home") == F.col("shard")).select("batch", *data)
    first = stored(_best(near.mapInArrow(_search(k, near.columns), _FOUND), k), "first")
    known = first.where(F.col("rank") == k).groupBy("batch").agg(
        F.collect_list(F.struct("place", "score")).alias("known"))  # at most BATCH of them
    # then every other shard: rows of one batch and one shard
    others = F.explode(F.sequence(F.lit(0), F.lit(shard_count - 1)))
    pairs = queries.join(known, "batch", "left").withColumn("to", others).where("to <> home")
    far = pairs.join(shards, F.col("to") == F.col("shard")).select("batch", "known", *data)
    rest = far.mapInArrow(_search(k, far.columns), _FOUND)
    return _best(first.drop("rank").unionByName(rest), k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
