import random

import brute
from ledgerlens.llm import simhash_dedup as S
from ledgerlens.llm.graph import connected_components
from llm_cases import SMALL_SF, messy, nothing  # noqa: F401


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL_SF}/documents.parquet").select("doc_id", "text").collect()
    rows += [(1000, None), (1001, ""), (1002, " \t"), (1003, "one"), (1003, "one"), (1004, "one two")]
    rows = sorted((tuple(r) for r in rows), key=lambda r: r[0])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prints = [brute.simhash(t) for _, t in rows]
    roots = brute.components(prints)
    got = sorted(tuple(r) for r in S.near_duplicates(docs).collect())
    assert got == sorted((i, "%016x" % p, rows[k][0]) for (i, _), p, k in zip(rows, prints, roots))


def test_links_of_any_radius(spark):
    rng = random.Random(2)
    for radius in (0, 1, 2, 4):
        values = {rng.getrandbits(64) for _ in range(40)}
        for v in list(values):
            for _ in range(3):
                w = v
                for _ in range(rng.randint(1, 5)):
                    w ^= 1 << rng.randint(0, 63)
                values.add(w)
        values = sorted(values)
        df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
        roots = {r["node"]: r["root"] for r in connected_components(S.linked(df, radius)).collect()}
        signed = [v - (1 << 64) if v >> 63 else v for v in values]
        got = {}
        for s in signed:
            got.setdefault(roots.get(s, s), set()).add(s)
        want = {}
        for s, k in zip(signed, brute.components(values, radius)):
            want.setdefault(k, set()).add(s)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_bk_tree():
    rng = random.Random(3)
    values = [rng.getrandbits(12) for _ in range(500)]
    tree = S.BKTree()
    for v in dict.fromkeys(values):
        tree.add(v)
    for q in values[:50]:
        assert {tree.values[i] for i in tree.within(q, 2)} == {v for v in values if (v ^ q).bit_count() <= 2}


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(5, 5), (300, 299)]
    random.Random(1).shuffle(edges)
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{100 + i: 100 for i in range(1, 40)}, 300: 299}


def test_keep_one(spark, messy, nothing):
    out = S.keep_one(messy)
    assert out.columns == messy.columns
    ids = [r["doc_id"] for r in out.collect()]
    # 1, 2 and 3 have no words; 4, 5 and 10 are one text but for case
    assert sorted(ids) == [1, 4, 6, 7, 8, 9, 11]
    assert S.keep_one(nothing).collect() == []
    # rows without an id are documents like others
    texts = [" ".join(f"{w}{i * 31 % 57}" for i in range(60)) for w in "abc"]
    more = spark.createDataFrame([(None, texts[0]), (None, texts[1]), (None, texts[1]), (3, texts[2]),
                                  (None, texts[2]), (4, texts[0][:-1] + "!"), (4, texts[1])],
                                 "doc_id long, text string")
    kept = {(r["doc_id"], r["text"]) for r in S.keep_one(more).collect()}
    assert len(kept) == S.keep_one(more).count() and {t for _, t in kept} >= {texts[2]}
    assert (3, texts[2]) in kept and (None, texts[2]) not in kept and (4, texts[1]) in kept
    assert S.near_duplicates(nothing).collect() == []


def test_long_text_by_blocks(monkeypatch):
    text = " ".join(str(i * i % 977) for i in range(5000))
    whole = S.fingerprint(text)
    monkeypatch.setattr(S, "_BLOCK", 7)
    assert S.fingerprint(text) == whole == brute.simhash(text)
