import numpy as np
import pyarrow as pa
from ledgerlens.llm import quality_fm as Q
from ledgerlens.llm import queries
from llm_cases import messy, nothing  # noqa: F401


def _features(texts):
    return list(Q.batch_features(pa.array(texts, pa.string()), Q.Featurizer()))


def test_pairwise_identity():
    machine, rng = Q.FactorisationMachine(rank=3), np.random.default_rng(1)
    machine.factors, machine.linear = rng.normal(size=machine.factors.shape), rng.normal(size=len(machine.linear))
    (rows, bucket, value, stats), = _features(["a few words, a few", "", None, "others\nothers\nhere!!"])
    got = machine.margin(rows, bucket, value, stats)[0]
    for r in range(4):
        x = np.zeros(len(machine.linear))
        np.add.at(x, bucket[rows[r]:rows[r + 1]], value[rows[r]:rows[r + 1]])
        x[Q.BUCKETS:] = machine._standard(stats)[r]
        on = np.flatnonzero(x)
        want = machine.bias + machine.linear @ x + sum(
            machine.factors[i] @ machine.factors[j] * x[i] * x[j] for k, i in enumerate(on) for j in on[:k])
        assert abs(got[r] - want) < 1e-6


def test_features_do_not_depend_on_the_batch(monkeypatch):
    texts = ["Some Text here.\nSome Text here.", None, "", " \n ", "ÄÖ ü 12 || x", "word " * 500, "a\n\nb\n\n"]
    together = _features(texts)[0]
    for i, t in enumerate(texts):
        (rows, bucket, value, stats), = _features([t])
        own = slice(together[0][i], together[0][i + 1])
        assert sorted(zip(bucket, value)) == sorted(zip(together[1][own], together[2][own]))
        assert np.allclose(stats[0], together[3][i])


def test_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op10_quality(spark, sf).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    right = [r["predicted"] == labels[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(right) > 0.98 * len(right)


def test_odd_rows(spark, messy, nothing):
    labels = spark.createDataFrame([(4, 1), (6, 0), (7, None), (None, 1), (8, 1)], "doc_id long, quality int")
    machine = Q.learnt_from(messy, labels)
    rows = Q.quality(messy, machine).collect()
    assert len(rows) == messy.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert Q.quality(nothing, machine).collect() == []
    blank = Q.learnt_from(messy, labels.where("false"))
    assert {round(r["score"], 6) for r in Q.quality(messy.where("doc_id < 3"), blank).collect()} == {0.5}


def test_sample_has_one_text_per_id(spark):
    from ledgerlens.llm.labelled import labelled_sample
    docs = spark.createDataFrame([(1, f"copy {i}") for i in range(500)] + [(2, "two"), (3, None), (3, None), (None, "x")],
                                 "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (None, 1), (4, 0)], "doc_id long, quality int")
    rows = labelled_sample(docs, labels, "quality", 10, 5).collect()
    assert len(rows) == 3 and {("two", 0), ("", 1)} < {(r["text"], r["label"]) for r in rows}
    assert sorted(rows) == sorted(labelled_sample(docs.repartition(2), labels, "quality", 10, 5).collect())
