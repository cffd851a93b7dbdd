"""Alignment of two tokenizers against a plain walk over the tokens of every text."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from llm_cases import messy, nothing  # noqa: F401
from ledgerlens.llm import token_alignment as ta
from ledgerlens.llm.queries import op13_token_alignment, tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenizers():
    return ta.Tokenizers(A, B)


def plain(texts, t):
    """Per text: counts, links and groups in writing, by the bytes of both token sequences."""
    out = []
    for text in texts:
        whole = b" " + (text or "").encode()
        a = t.a.encode(" " + (text or ""), add_special_tokens=False).ids
        b = t.b.encode(text or "")
        if not text or b"".join(t.bytes_a[i] for i in a) != whole or b"".join(t.bytes_b[i] for i in b) != whole:
            out.append((0, 0, 0, [], ""))
            continue
        spans = []
        for ids, size in ((a, t.bytes_a), (b, t.bytes_b)):
            at, row = 0, []
            for i in ids:
                row.append((at, at + len(size[i]), i))
                at += len(size[i])
            spans.append(row)
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
        cuts = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]})
        groups, low = [], 0
        for cut in cuts:
            side = [",".join(str(s[2]) for s in row if low < s[1] <= cut) for row in spans]
            groups.append("|".join(side))
            low = cut
        out.append((len(a), len(b), len(cuts), links, ";".join(groups)))
    return out


def report(texts, t):
    rows = plain(texts, t)
    count = Counter(p for r in rows for p in r[3])
    most = {}
    for (_, b), n in count.items():
        most[b] = max(n, most.get(b, 0))
    return [(n_a, n_b, n_groups, len(links), sum(count[p] == most[p[1]] for p in links),
             sum(count[p] for p in links), hashlib.sha256(g.encode()).hexdigest() if links else "")
            for n_a, n_b, n_groups, links, g in rows]


ODD = ["", None, " ", "  two  spaces ", "tab\tand\nline \n x", "<s> </s> <|endoftext|> <unk> <0x41>", "▁ mark a▁b",
       "漢字 かな 😀 👩‍👩‍👧 é", "don't we'll it's 12345 3.14", "a" * 3000, "\x00\x01 \x7f ctrl", "a  b   c",
       "x ​ y", "end ", "\nstart", "\u001c sep \u001d a", "Ünïcödé ßtraße", "a  b   c    d", "- -- --- !!! ??"]


def test_equal_to_a_plain_walk(spark, tokenizers):
    texts = ODD + ["the cat sat on the mat " * 7] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in ta.alignment(docs.repartition(3), A, B, chunk_text=40).collect()}
    assert [got[i] for i in range(len(texts))] == report(texts, tokenizers)


def test_table_equals_a_plain_walk(spark, tokenizers):
    from conftest import SMALL_SF
    rows = spark.read.parquet(f"{SMALL_SF}/documents.parquet").select("doc_id", "text").collect()
    rows = sorted(rows)
    short = [r for r in rows if len(r["text"] or "") < 4000][:80]
    docs = spark.createDataFrame(short, "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in ta.alignment(docs, A, B).collect()}
    want = report([r["text"] for r in short], tokenizers)
    assert [got[r["doc_id"]] for r in short] == want


def test_units_encode_as_whole_texts(tokenizers):
    """Random texts of odd characters: the units' tokens are those of the whole text."""
    rng = np.random.default_rng(5)
    signs = list("ab Z9.'-\n\t  ") + ["é", "漢", " ", " ", "😀", "‍", "\x1c", "\x85", "’", "<s>", "ll", " the"]
    for _ in range(1500):
        text = "".join(rng.choice(signs, int(rng.integers(1, 40))))
        units = [u for part in ta.slices(text, True, 9) for u in part]
        a, b = tokenizers.encode(units)
        whole_a, whole_b = tokenizers.encode([text])
        assert sum(a, []) == whole_a[0], text
        assert sum(b, []) == whole_b[0], text


def test_planes_give_back_documents_and_times():
    rng = np.random.default_rng(3)
    docs = 700
    want = {(int(p), int(d)): int(rng.integers(1, 40)) for p in range(30)
            for d in rng.choice(docs, int(rng.integers(1, 600)), replace=False)}
    keys = sorted(want)
    pair, doc = (np.array(x) for x in zip(*keys))
    bits = ta.planes_of(pair, doc, np.array([want[k] for k in keys]), docs)
    got = Counter()
    for row, number, links in ta.walk(bits):
        for r, d, n in zip(row.tolist(), number.tolist(), links.tolist()):
            got[r, d] += n
    assert got == want
    assert sum(len(b.as_py()) for b in bits) < 2 * sum(bin(n).count("1") for n in want.values())


def test_pair_counts_count_documents_and_links(spark, tokenizers):
    texts = ["the mat the mat", "the cat", "the mat", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    rows = plain(texts, tokenizers)
    links = Counter(p for r in rows for p in r[3])
    held = Counter(p for r in rows for p in set(r[3]))
    got = {(r["a"], r["b"]): (r["n_docs"], r["n_links"]) for r in ta.aligned_pairs(docs, A, B).collect()}
    assert got == {p: (held[p], links[p]) for p in links}


def test_odd_tables(messy, nothing):
    assert ta.alignment(nothing, A, B).collect() == []
    rows = ta.alignment(messy, A, B).collect()
    assert len(rows) == messy.count()
    twice = [tuple(r) for r in rows if r["doc_id"] == 8]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert [tuple(r)[1:] for r in rows if r["doc_id"] in (1, 2)] == [(0, 0, 0, 0, 0, 0, "")] * 2
    assert any(r["doc_id"] is None and r["n_a"] > 0 for r in rows)


def test_query_columns(spark):
    from conftest import SMALL_SF
    df = op13_token_alignment(spark, SMALL_SF)
    assert df.dtypes == [("doc_id", "bigint"), ("n_a", "bigint"), ("n_b", "bigint"), ("n_groups", "bigint"),
                         ("n_links", "bigint"), ("n_best", "bigint"), ("count_sum", "bigint"),
                         ("groups_sha256", "string")]
    assert df.count() == 200
