"""The conversation trie against a plain walk, and its blocks against their size."""

import hashlib
import random
import re
import zlib

import duckdb
from llm_cases import SMALL_SF

from ledgerlens.llm import prefix_trie as pt
from ledgerlens.llm import queries
from ledgerlens.llm.queries import op11_conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def rebuilt(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, digest(role or "", text or ""),
                                            (role or "", text or "")))
    own = {c: [t[3] for t in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, turns in own.items():
        h = (zlib.crc32(str(c).encode()) & 0xFFFFFFFF) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def plain(rows):
    convs = rebuilt(rows)
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        under = [p for p in nodes if p[:len(path)] == path]
        ends = sorted(c for c in members if len(convs[c]) == len(path))
        saved = sum((len(nodes[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in under if p)
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
                    sum(len(p) == len(path) + 1 for p in under),
                    sum(not any(q != p and q[:len(p)] == p and len(q) == len(p) + 1 for q in under) for p in under),
                    saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def made(seed, convs, longest, words=3):
    """Conversations that share beginnings of any length, some of them equal."""
    rng, rows, known = random.Random(seed), [], [[]]
    for c in rng.sample(range(-40, 3 * convs), convs):
        base = rng.choice(known)
        turns = base[:rng.randint(0, len(base))]
        while len(turns) < longest and rng.random() < 0.8:
            turns = turns + [(rng.choice(["user", "assistant", None]), " ".join(rng.choices("ab cd\te", k=words)))]
        known.append(turns)
        rows += [(c, k if rng.random() < 0.9 else k - 1, role, text) for k, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    return rows


def test_equal_to_a_plain_walk(spark):
    for seed, longest in ((1, 6), (2, 30)):
        rows = made(seed, 60, longest)
        df = spark.createDataFrame(rows, SCHEMA).repartition(5)
        assert got(pt.conversation_trie(df)) == plain(rows)


def test_table_equals_a_plain_walk(spark):
    df = spark.read.parquet(f"{SMALL_SF}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert got(op11_conversation_trie(spark, SMALL_SF)) == plain(rows)


def test_table_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SMALL_SF}/conversations.parquet'")
    want = con.sql(queries.OP11_SQL)
    df = queries.op11_conversation_trie(spark, SMALL_SF)
    assert df.columns == want.columns
    assert {t for _, t in df.dtypes} == {"bigint", "string"} and {str(t) for t in want.types} == {"BIGINT", "VARCHAR"}
    assert got(df) == sorted(want.fetchall(), key=str)


def test_block_size_changes_nothing(spark):
    rows = made(7, 40, 20)
    df = spark.createDataFrame(rows, SCHEMA)
    turns, convs = pt.exchanged_heads(pt.numbered_turns(df))
    assert got(pt.prefix_trie(turns, convs, block=1)) == got(pt.prefix_trie(turns, convs, block=5)) == plain(rows)


def test_only_diverging_blocks_are_refined(spark):
    """300 equal conversations and one that leaves them in the third block."""
    shared = [("u", f"turn {k}") for k in range(40)]
    rows = [(c * 20, k, *t) for c in range(300) for k, t in enumerate(shared)]
    rows += [(9999 * 20, k, *t) for k, t in enumerate([*shared[:18], ("u", "else"), ("u", "x")])]
    turns, convs = pt.exchanged_heads(pt.numbered_turns(spark.createDataFrame(rows, SCHEMA)))
    edges = pt._edges(pt._members(turns, 8)).select("block", "n", "split").collect()
    assert sorted((e["block"], e["n"], e["split"]) for e in edges) == [
        (0, 301, True), (1, 301, False), (2, 1, True), (2, 300, True), (3, 300, False), (4, 300, False)]
    assert got(pt.prefix_trie(turns, convs)) == plain(rows)


def test_ends_of_one_node_in_many_pieces(spark):
    rows = [(c, 0, "u", "same") for c in range(-700, 3000)]
    top = [r for r in got(pt.conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(7))) if r[1] == 1]
    assert top == [r for r in plain(rows) if r[1] == 1]


def test_odd_tables(spark):
    odd = [(None, 0, "u", "lost"), (1, None, None, None), (1, None, None, None), (1, 0, "u", ""),
           (2, 2**62, "u", "late"), (2, -2**62, "a", "early"), (3, 1, "u", "tie b"), (3, 1, "u", "tie a"),
           (40, 0, "u", "word " * 30_000), (-2**63 + 7, 5, "x", "low"), (20, 1, "u", "a"), (21, 1, "u", "a")]
    df = spark.createDataFrame([(*r, 5, "w") for r in odd], SCHEMA + ", pos long, words string")
    assert got(pt.conversation_trie(df)) == plain(odd)
    assert pt.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_hot_conversation(spark):
    """One conversation with most of the turns, of spread turn numbers."""
    rows = [(5, k * 2**40 - 2**50, "u", f"t{k % 7}") for k in range(3000)] + made(9, 20, 5)
    rows = [r for r in rows if r[0] != 5 or r[3].startswith("t")]
    turns, convs = pt.exchanged_heads(pt.numbered_turns(spark.createDataFrame(rows, SCHEMA)))
    nodes = {(r["conv_id"], r["depth"]): r for r in pt.prefix_trie(turns, convs).collect()}
    length = len(rebuilt(rows)[5])
    assert nodes[5, length]["n_children"] == 0 and nodes[5, length]["n_leaves"] == 1
    assert nodes[5, length - 1]["parent_conv_id"] == 5
