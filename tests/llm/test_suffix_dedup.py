import random

import brute
import pytest
from ledgerlens.llm import suffix_dedup as S
from llm_cases import messy, nothing  # noqa: F401


def _texts(seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcde ") for _ in range(rng.randint(60, 300))) for _ in range(8)]
    texts = [None, "", "short", "y" * 700, "ab" * 300, "é" * 120, "é" * 119]
    for _ in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.5 else
                 "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 200))) for _ in range(rng.randint(1, 5))]
        text = "".join(parts)
        if rng.random() < 0.3:
            a = rng.randint(0, len(text))
            text = text[:a] + "#" + text[a:]
        texts.append(text)
    return texts + texts[10:20]


@pytest.mark.parametrize("batches,chunk,wide", [(1, 1 << 21, 4096), (5, 777, 4096), (3, 777, 2)])
def test_report_equals_brute_force(spark, monkeypatch, batches, chunk, wide):
    monkeypatch.setattr(S, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(S, "WIDE", wide)
    monkeypatch.setattr(S, "_SORTED", 64 if batches > 1 else S._SORTED)
    texts = _texts(batches)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, __sha string")
    got = {r["doc_id"]: r for r in S.repeat_report(docs, length=100, batches=batches).collect()}
    assert len(got) == len(texts)
    for i, (removed, runs, kept) in enumerate(brute.repeats(texts, 100)):
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len((texts[i] or "").encode()), removed, runs), i
        assert r["kept_sha256"] == __import__("hashlib").sha256(kept).hexdigest()


def test_levels_merge_geometrically(spark):
    index = S.SuffixIndex(spark, buckets=2)
    docs = spark.createDataFrame([(i, f"{i}" * 300) for i in range(12)], "doc_id long, text string")
    texts = docs.select(*S._identity("doc_id", "text"))
    for k in range(7):
        index.add(S.suffix_entries(texts.where(f"__did % 7 = {k}"), 100)).count()
    index.settle()
    assert sorted(index.levels) == [0, 1, 2]  # seven batches: 1 + 2 + 4


def test_remove_keeps_rows_and_columns(spark, messy):
    out = S.remove_repeats(messy)
    assert out.columns == messy.columns
    rows = out.collect()
    assert len(rows) == messy.count()
    by_id = {r["doc_id"]: r["text"] for r in rows}
    source = messy.collect()
    kept = brute.repeats([r["text"] for r in source])
    for r, (_, _, left) in zip(source, kept):
        want = None if r["text"] is None else left.decode("utf-8", "ignore")
        assert by_id[r["doc_id"]] == want


def test_repeated_rows_remove_each_other(spark):
    text = " ".join(str(i * i) for i in range(100))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text[:150])], "doc_id long, text string")
    got = S.repeat_report(docs).orderBy("doc_id").collect()
    assert [r["n_removed"] for r in got] == [len(text), len(text), 0]


def test_texts_without_id_of_one_32_bit_hash(spark):
    from hashlib import sha256
    one, two = ("".join(sha256(f"{c}{n}".encode()).hexdigest() for c in "abcd") for n in (210, 34664))
    docs = spark.createDataFrame([(None, one), (None, two), (1, one[:200])], "doc_id long, text string")
    assert len({r[0] for r in docs.limit(2).selectExpr("hash(doc_id, text)").collect()}) == 1
    got = {r["kept_sha256"]: r["n_removed"] for r in S.repeat_report(docs).collect()}
    assert got == {sha256(one[200:].encode()).hexdigest(): 200, sha256(two.encode()).hexdigest(): 0,
                   sha256(b"").hexdigest(): 200}


def test_empty_table(nothing):
    assert S.repeat_report(nothing).collect() == []
