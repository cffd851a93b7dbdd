import random

import sentencepiece
from ledgerlens.llm import queries
from ledgerlens.llm import token_count as T
from llm_cases import SMALL_SF, messy, nothing  # noqa: F401

MODEL = queries.tokenizer_path("piece_bpe_32k.model")


def _whole(texts):
    p = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return [len(p.encode(t or "")) for t in texts]


def test_parts_add_up(monkeypatch):
    rng = random.Random(1)
    pieces = ["a", " ", "  ", "b", "\n", "é", "the", "</s>", "<s>", "\t", "　", "▁", "\x00", "0", "99", "😀", "of"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    for limit in (1 << 20, 5):
        monkeypatch.setattr(T._slices, "__defaults__", (limit,))
        count = T._counter(MODEL)
        assert [count(t) for t in texts] == _whole(texts)


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL_SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in queries.op9_token_counts(spark, SMALL_SF).collect()}
    for r, n in zip(docs, _whole([r["text"] for r in docs])):
        g = got[r["doc_id"]]
        assert (g["n_tokens"], g["n_bytes"], g["over_limit"]) == (n, len(r["text"].encode()), n > 4096)


def test_odd_rows(messy, nothing):
    rows = T.token_counts(messy, MODEL).collect()
    texts = messy.collect()
    assert sorted(r["n_tokens"] for r in rows) == sorted(_whole([t["text"] for t in texts]))
    assert {r["n_bytes"] for r in rows if r["doc_id"] in (1, 2)} == {0}
    assert T.token_counts(nothing, MODEL).collect() == []
