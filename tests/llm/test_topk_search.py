import math
import random

import pytest
from ledgerlens.llm import queries
from ledgerlens.llm import topk_search as T
from pyspark.sql import functions as F


def _brute(rows, k=5):
    ok = [(i, [math.floor(256.0 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(ok):
        if i % 50 == 0:
            found = sorted((max(-2**63, min(2**63 - 1, sum(x * y for x, y in zip(q, v)))), -j)
                           for b, (j, v) in enumerate(ok) if b != a)[::-1][:k]
            out += [(i, n + 1, -j, s) for n, (s, j) in enumerate(found)]
    return sorted(out)


def _rows(seed, n):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.2) for c in rng.choice(centres)]) for i in range(n)]
    return rows + [(50, rows[50][1]), (50, rows[51][1]), (150, [0.0] * 6), (777, None), (None, [1.0]),
                   (778, [float("nan")] * 6), (779, [1.0, None]), (780, [float("inf")]), (800, []),
                   (850, [0.5, -0.5]), (-50, rows[3][1]), (900, [2.0] * 9)]


@pytest.mark.parametrize("block,shard,batch", [(64, 8192, 1024), (3, 7, 2)])
def test_equals_brute_force(spark, monkeypatch, block, shard, batch):
    for name, v in (("BLOCK", block), ("SHARD", shard), ("BATCH", batch)):
        monkeypatch.setattr(T, name, v)
    rows = _rows(block, 220)
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, score int, shard string")
    got = sorted(tuple(r) for r in T.top_k(table, F.col("id") % 50 == 0).collect())
    assert got == _brute(rows)


def test_huge_components(spark):
    rows = [(i, [1e15 * (i - 3), 3.0 * i, -1e14]) for i in range(8)] + [(50, [1e300, 1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in T.top_k(table, F.col("id") % 50 == 0).collect()) == _brute(rows)


def test_one_vector_repeated_in_many_parts(spark, monkeypatch):
    monkeypatch.setattr(T, "SHARD", 4)
    rows = [(50, [0.25, 0.5])] * 30 + [(i, [0.25, 0.5]) for i in range(60, 80)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in T.top_k(table, F.col("id") == 50).collect()) == _brute(rows)


def test_empty_and_single(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert T.top_k(table, F.col("id") % 50 == 0).collect() == []
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert T.top_k(one, F.col("id") % 50 == 0).collect() == []


def test_query_equals_sql(spark):
    import duckdb
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    assert sorted(tuple(r) for r in queries.op3_topk(spark, sf).collect()) == sorted(con.sql(queries.OP3_SQL).fetchall())


def test_blocks_are_pruned():
    import numpy as np
    rng = np.random.default_rng(1)
    m = np.sort(rng.integers(-200, 200, (2048, 8)), axis=0).astype(float)
    index, seen = T.ShardIndex(np.arange(2048), m), []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, slice):
                seen.append(key)
            return super().__getitem__(key)

    index.matrix = m.view(Counted)
    list(index.search(np.array([-1]), np.full((1, 8), 100.0), 5, np.array([-np.inf])))
    assert len(seen) < len(index.cuts) / 4
