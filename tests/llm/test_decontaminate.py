import random

import brute
import pytest
from ledgerlens.llm import decontaminate as D
from llm_cases import messy, nothing  # noqa: F401


def _case():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["Äpfel", "naïve", "漢字", "A1"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 12, 13, 14, 40])))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "..."), (7, items[7][1])]
    texts = [None, "", "!!"]
    for _ in range(60):
        t = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.6:
            t[rng.randint(0, len(t)):0] = (rng.choice(items)[1] or "").upper().split()
        texts.append(rng.choice([" ", ", ", "\n"]).join(t))
    return items, texts


@pytest.mark.parametrize("max_set_bytes", [1 << 20, 300])
def test_hits_equal_brute_force(spark, max_set_bytes):
    items, texts = _case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = D.contaminated(D.benchmark_hits(docs, bench, max_set_bytes=max_set_bytes)).collect()
    got = {r["doc_id"]: r for r in rows}
    for i, (n, hit, ids) in enumerate(brute.contamination(texts, items)):
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == (n, hit, len(ids), brute.sha(ids)), texts[i]
        assert r["contaminated"] == (hit > 0 and 20 * hit >= n)


def test_long_texts_in_parts():
    import numpy as np
    items, texts = _case()
    scanner = D.WindowScanner(D.windows_of([(str(i), t) for i, t in items], 13))
    raw = "  ".join(t for t in texts if t).encode()
    buf, off = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
    (whole,) = scanner.rows(buf, off, 1 << 20)
    (parts,) = scanner.rows(buf, off, 97)
    assert all((a == b).all() for a, b in zip(whole[:3], parts[:3])) and whole[3] == parts[3]


def test_long_texts_with_gaps():
    import numpy as np
    passage = [f"word{i}" for i in range(13)]
    scanner = D.WindowScanner(D.windows_of([("1", " ".join(passage)), ("2", "one two three")], 13))
    for gap in (" ", "\0" * 150, "-" * 96, "\n" * 1000):
        raw = f"some text {gap.join(passage)} and more words {gap} one{gap}two{gap}three {gap}".encode()
        buf, off = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
        (whole,) = scanner.rows(buf, off, 1 << 20)
        (parts,) = scanner.rows(buf, off, 97)
        assert all((a == b).all() for a, b in zip(whole[:3], parts[:3])) and whole[3] == parts[3] == {"1", "2"}


def test_modes_and_odd_rows(spark, messy, nothing):
    bench = spark.createDataFrame([(1, "alpha beta"), (2, "one")], "item_id long, text string")
    kept = D.decontaminate(messy, bench, share=20)
    assert kept.columns == messy.columns
    assert {8} & {r["doc_id"] for r in kept.collect()} == set()
    spans = D.decontaminate(messy, bench, mode="spans")
    assert spans.count() == messy.count() and spans.where("doc_id = 8").first()["text"] == ""
    assert D.contaminated(D.benchmark_hits(nothing, bench)).collect() == []
    empty = D.benchmark_hits(messy, bench.where("false")).agg({"n_hit": "sum"}).first()[0]
    assert empty == 0
