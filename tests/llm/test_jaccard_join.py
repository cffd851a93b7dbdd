"""The Jaccard join against all pairs of plain Python sets."""

import random
import re

import duckdb
import numpy as np
import pytest
from brute import lower_ascii
from llm_cases import SMALL_SF, messy, nothing  # noqa: F401

from ledgerlens.llm import jaccard_join as jj
from ledgerlens.llm import queries
from ledgerlens.llm.common import RollingHash

SCHEMA = "doc_id long, text string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text))


def shingles(text, width=5):
    w = words(text)
    if not w:
        return frozenset()
    n = min(width, len(w))
    return frozenset(" ".join(w[i:i + n]) for i in range(len(w) - n + 1))


def plain(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * len(a | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((i, len(sets[k]), i if not sets[k] else least.get(root(k))) for k, (i, _) in enumerate(rows)), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def near_copies(seed, families, size, edits, shared=()):
    """Texts in families: copies of a text with some words changed, with common passages."""
    rng, out = random.Random(seed), []
    for f in range(families):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(6, 90))]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randint(0, edits)):
                text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
            if shared and rng.random() < 0.5:
                text += rng.choice(shared).split()
            out.append(" ".join(text))
    rng.shuffle(out)
    return list(enumerate(out))


PASSAGES = [" ".join(f"p{k}x{i}" for i in range(30)) for k in range(2)]


@pytest.mark.parametrize("families,size,edits", [(40, 5, 3), (2, 90, 4)])
def test_equal_to_all_pairs(spark, families, size, edits):
    rows = near_copies(families, families, size, edits, PASSAGES)
    want = plain(rows)
    assert len({c for _, _, c in want}) < len(rows) - 10
    assert got(jj.jaccard_components(spark.createDataFrame(rows, SCHEMA).repartition(4), chunk_bytes=4000)) == want


@pytest.mark.parametrize("postings", [40, 600])
def test_families_of_several_cells(spark, postings):
    rows = near_copies(11, 6, 40, 5, PASSAGES)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(jj.jaccard_components(df, cell_postings=postings)) == plain(rows)


def test_table_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL_SF}/documents.parquet'")
    assert got(queries.op12_jaccard(spark, SMALL_SF)) == sorted(con.sql(queries.OP12_SQL).fetchall(), key=str)


def test_links_of_a_cell_against_all_pairs():
    """Every entry of another component that is similar enough is found, in any order of links."""
    rng = np.random.default_rng(4)
    base = [rng.choice(10**9, 60, replace=False) for _ in range(6)]
    sets = []
    for _ in range(120):
        b = base[rng.integers(6)]
        kept = b[rng.random(60) < 0.93]
        sets.append(np.unique(np.concatenate([kept, rng.choice(10**9, 3)])).astype(np.uint64))
    sets.sort(key=len)
    sizes = [len(s) for s in sets]
    cell = jj.Cell(list(range(120)), sizes, sets, list(range(120)), 80)
    for k, s in enumerate(sets * 2):
        few, k = k // 120, k % 120
        jj.FEW = 0 if few else 16
        cell.label[:] = np.arange(120)
        cell.parts = {i: [i] for i in range(120)}
        found = []
        for x in cell.links(s, len(s), k, 0, 120):
            found.append(x)
            cell.mine = cell.unite(k, x)
        want = [j for j, t in enumerate(sets) if j != k
                and 100 * len(np.intersect1d(s, t)) >= 80 * len(np.union1d(s, t))]
        assert sorted(found) == want
    jj.FEW = 16


def test_long_texts_are_hashed_in_slices(monkeypatch):
    rng = random.Random(1)
    text = " ".join("x" * rng.randint(1, 40) + str(rng.randrange(50)) for _ in range(400)) + "\t\n " + "Long" * 300 + " a b"
    whole = jj.shingle_set(text.encode(), 5, RollingHash(1 << 16))
    assert len(whole) == len(shingles(text))
    for size in (7, 64, 333):
        monkeypatch.setattr(jj, "SLICE_BYTES", size)
        assert (jj.shingle_set(text.encode(), 5, RollingHash(size)) == whole).all()


def test_threshold_is_met_exactly(spark):
    """Nine of ten common shingles of two sets of ten, and eight of twelve."""
    a = " ".join(f"w{i}" for i in range(13))  # 9 shingles
    rows = [(1, a), (2, a + " x"), (3, a + " x y"), (4, a + " x y z q")]
    assert got(jj.jaccard_components(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_odd_tables(spark, messy, nothing):
    assert jj.jaccard_components(nothing).collect() == []
    rows = [(r["doc_id"], r["text"]) for r in messy.collect()]
    assert got(jj.jaccard_components(messy)) == plain(rows)
    none = [(None, "a b c d e f"), (None, "a b c d e f"), (None, None), (5, ""), (5, "one"), (6, "one")]
    assert got(jj.jaccard_components(spark.createDataFrame(none, SCHEMA))) == plain(none)
