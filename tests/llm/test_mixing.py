from fractions import Fraction

import brute
import duckdb
import pytest
from ledgerlens.llm import queries
from ledgerlens.llm.mixing import mix_sources
from llm_cases import SMALL_SF, messy, nothing  # noqa: F401


def _mix(rows):
    return [r.asDict() for r in rows.collect()]


@pytest.mark.parametrize("weights,budget,epochs", [((3, 1, 2), Fraction(3, 2), 2), ((1,), Fraction(1), 4),
                                                   ((5, 1), Fraction(7, 3), 3)])
def test_targets_are_met(spark, weights, budget, epochs):
    docs = spark.createDataFrame(
        [(i, "w " * (i * 37 % 50), None if i % 11 == 0 else "abcdefg"[min(i % 9, 6)]) for i in range(300)],
        "doc_id long, text string, source string")
    rows = _mix(mix_sources(docs, weights, budget, epochs))
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is None, s))
    sizes = [sum(r["size"] for r in rows if r["source"] == s) for s in sources]
    for s, n, want in zip(sources, sizes, brute.water(sizes, weights, budget, epochs)):
        own = [r for r in rows if r["source"] == s]
        assert all(r["target"] == pytest.approx(float(want)) and r["source_size"] == n for r in own)
        assert 0 <= want - sum(r["taken"] for r in own) < 1
        assert all(0 <= r["taken"] <= epochs * r["size"] for r in own)


def test_reruns_agree_and_sql(spark):
    a = sorted(tuple(r) for r in queries.op6_mixing(spark, SMALL_SF).collect())
    b = sorted(tuple(r) for r in queries.op6_mixing(spark, SMALL_SF).collect())
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL_SF}/documents.parquet'")
    assert a == b == sorted(con.sql(queries.OP6_SQL).fetchall())


def test_odd_rows(messy, nothing):
    rows = _mix(mix_sources(messy))
    assert len(rows) == messy.count()
    assert {r["doc_id"]: r["size"] for r in rows if r["doc_id"] in (1, 2, 3, 8)} == {1: 0, 2: 0, 3: 0, 8: 1}
    assert mix_sources(nothing).collect() == []
    assert [r["target"] for r in _mix(mix_sources(messy.where("doc_id < 4")))] == [0.0] * 3
