"""Prefix trie of conversations (operator 11): fixed-length block hashing.

Conversations that begin with the same turns share a node of the trie for each of these turns.
Turns are numbered and reduced to digests once; a conversation is then cut into blocks of
``BLOCK`` turns. The key of a sequence of turns is the XOR of 128-bit hashes of all its
(position, turn) pairs, so the keys before and after every block are running XORs, which a tree
of totals takes without holding a conversation in one task.

Conversations are grouped by (key before, key after) of a block first: one *edge* per different
block, however many conversations hold it. Only where an edge has fewer conversations than its
parent, so that siblings diverge somewhere inside the block, are turn boundaries refined: the
turns of such edges are grouped by their own keys. In every other block all nodes have the
conversations of their edge, and nothing is grouped.

Totals over subtrees need no walk over levels. A node belongs to its smallest conversation, its
owner; the nodes that a conversation owns are the lower end of its path. So the total below a node
is the sum of what its conversations own, less what its own owner owns above the node: one sum
over the same edges, and one running total along the owned paths.

Conversations without an id are left out. A null role or text is empty. Turns are ordered by turn
(null first), then by the digest of role and text; repeated rows are turns of their own.
Conversations whose turns all fell away when heads were exchanged end at the root. An empty table
has no nodes. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import surrogate_key
from ..operators.scan import totals_before
from .common import stored

#: Turns of a block.
BLOCK = 8
WORD = r"[^\x20\x09-\x0D]+"

_EDGE = ["block", "p1", "p2", "d1", "d2"]
_NODE = ["depth", "k1", "k2"]


def numbered_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv, pos, digest, words`` of each turn: its position from 1, the first 128 bits of the
    SHA-256 of role and text, and its words. The texts are not shuffled."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.unhex(F.substring(F.sha2(whole, 256), 1, 32)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    rows = stored(rows, "turns")
    return surrogate_key(rows, "turn", [F.col("digest")], "pos", keys=["conv"]) \
        .select("conv", "pos", "digest", "words")


def exchanged_heads(turns: DataFrame, period: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Turns and conversations (``conv, length``) after the first turns were exchanged: the first
    h turns of conversation c become the first h of conversation c - c % ``period`` (all it has,
    if fewer), where h is the CRC-32 of c in decimal, modulo ``most``."""
    heads = (turns.where((F.col("conv") % period == 0) & (F.col("pos") < most)).groupBy("conv")
             .agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "words"))).alias("head"))
             .select(F.col("conv").alias("base"), "head"))
    head_size = F.crc32(F.col("conv").cast("string")) % most
    convs = (turns.groupBy("conv").agg(F.max("pos").alias("n"))
             .withColumn("h", head_size).withColumn("base", F.col("conv") - F.col("conv") % period))
    convs = convs.join(heads, "base", "left").withColumn(
        "head", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1),
                        F.col("h").cast("int")))
    convs = stored(convs.select(
        "conv", "head", (F.size("head") - F.col("h")).alias("shift"),
        (F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "convs")
    first = convs.select("conv", F.explode("head").alias("t")).select("conv", "t.*")
    moved = convs.where("shift < 0").select(F.col("conv").alias("__conv"), "shift")
    own = (turns.where(F.col("pos") > head_size).join(moved, F.col("conv") == F.col("__conv"), "left")
           .withColumn("pos", F.col("pos") + F.coalesce("shift", F.lit(0))).select(*first.columns))
    return first.unionByName(own), convs.select("conv", "length")


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def _members(turns: DataFrame, block: int) -> DataFrame:
    """A row per conversation and block: the keys before and after it, and its turns."""
    marks = turns.select(
        "conv", F.expr(f"(pos - 1) DIV {block}").alias("block"),
        F.struct("pos", F.xxhash64("pos", "digest").alias("t1"),
                 F.xxhash64("digest", "pos", F.lit(7)).alias("t2"), "words").alias("turn"))
    blocks = stored(marks.groupBy("conv", "block").agg(
        F.bit_xor("turn.t1").alias("x1"), F.bit_xor("turn.t2").alias("x2"),
        F.sort_array(F.collect_list("turn")).alias("turns")), "blocks")
    keyed = totals_before(blocks, ["conv"], "block", {"p1": ("xor", "x1"), "p2": ("xor", "x2")})
    return stored(keyed.select("conv", "block", "p1", "p2", _xor(F.col("p1"), F.col("x1")).alias("d1"),
                               _xor(F.col("p2"), F.col("x2")).alias("d2"), "turns"), "members")


def _edges(members: DataFrame) -> DataFrame:
    """A row per different block after the same turns: its conversations, the smallest of them,
    whether its siblings diverge (``split``), and its nodes."""
    def key(i, field, before):
        return F.aggregate(F.slice("turns", F.lit(1), i + 1), F.col(before), lambda a, t: _xor(a, t[field]))

    nodes = F.transform("turns", lambda t, i: F.struct(
        t["pos"].alias("depth"), key(i, "t1", "p1").alias("k1"), key(i, "t2", "p2").alias("k2"),
        t["t1"].alias("t1"), t["t2"].alias("t2"), t["words"].alias("words")))
    edges = members.groupBy(*_EDGE).agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("first"),
                                        F.any_value("turns").alias("turns"))
    edges = stored(edges.select(*_EDGE, "n", "first", nodes.alias("nodes")), "edges")
    parents = edges.select((F.col("block") + 1).alias("block"), F.col("d1").alias("p1"),
                           F.col("d2").alias("p2"), F.col("n").alias("through"))
    return edges.join(parents, ["block", "p1", "p2"], "left") \
        .withColumn("split", ~F.coalesce(F.col("n") == F.col("through"), F.lit(False)))


def _refined(edges: DataFrame, sums: dict[str, Column], others: dict[str, Column]) -> DataFrame:
    """A row per node below the root: as they are where siblings do not diverge, else with
    ``sums`` added up over the edges that share a turn boundary."""
    rows = edges.select("split", *sums, *[c for c in others if c in edges.columns], F.explode("nodes").alias("node")) \
        .select("split", *sums, *[c for c in others if c in edges.columns], "node.*")
    kept = [*_NODE, *sums, *others]
    split = rows.where("split").groupBy(*_NODE).agg(
        *[F.sum(c).alias(c) for c in sums], *[agg.alias(c) for c, agg in others.items()])
    return rows.where("NOT split").select(*kept).unionByName(split.select(*kept))


def _end_digests(ends: DataFrame) -> DataFrame:
    """``ends_sha256`` of each node where conversations end (``conv`` and the node's key): the
    ids, sorted over all tasks by range, are joined to pieces where they lie; only the pieces of
    a node meet in one task, which feeds them to the hash one by one."""
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depth, k1, k2, conv = (c.to_pylist() for c in batch.columns)
            out, a = [], 0
            for b in range(1, len(conv) + 1):
                if b == len(conv) or (depth[b], k1[b], k2[b]) != (depth[a], k1[a], k2[a]):
                    out.append((depth[a], k1[a], k2[a], conv[a], ",".join(map(str, conv[a:b]))))
                    a = b
            if out:
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in list(zip(*out, strict=True))[:4]),
                     pa.array([r[4] for r in out], pa.string())], names=[*_NODE, "conv", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        node = digest = None
        for batch in batches:
            out = []
            for *key, ids in zip(*(batch.column(j).to_pylist() for j in (0, 1, 2, 4)), strict=True):
                if key == node:
                    digest.update(b",")
                else:
                    if node is not None:
                        out.append((*node, digest.hexdigest()))
                    node, digest = key, sha256()
                digest.update(ids.encode())
            yield rows_of(out)
        if node is not None:
            yield rows_of([(*node, digest.hexdigest())])

    def rows_of(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [*(pa.array([r[j] for r in out], pa.int64()) for j in range(3)),
             pa.array([r[3] for r in out], pa.string())], names=[*_NODE, "ends_sha256"])

    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = ends.select(*[F.col(c).cast("long").alias(c) for c in _NODE], "conv")
    chunks = (rows.repartitionByRange(n, *_NODE, "conv").sortWithinPartitions(*_NODE, "conv")
              .mapInArrow(joined, "depth long, k1 long, k2 long, conv long, ids string"))
    return (chunks.repartition(n, *_NODE).sortWithinPartitions(*_NODE, "conv")
            .mapInArrow(hashed, "depth long, k1 long, k2 long, ends_sha256 string"))


def prefix_trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The trie of ``turns`` (``conv, pos, digest, words``, positions from 1 without gaps) of the
    conversations ``convs`` (``conv, length``). A row per node: ``conv_id`` (its smallest
    conversation), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves`` (nodes
    without children in its subtree), ``saved_tokens`` (the subtree's sum of words of the last turn
    times further conversations) and ``ends_sha256`` (of the ids that end here)."""
    members = _members(turns, block)
    edges = _edges(members)
    below = _refined(edges, {"n": None}, {
        "first": F.min("first"), "words": F.any_value("words"), "t1": F.any_value("t1"), "t2": F.any_value("t2")})
    none = F.lit(0).cast("long")
    root = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("first")).where("n > 0")
    root = root.select(none.alias("depth"), none.alias("k1"), none.alias("k2"), "n", "first",
                       none.alias("words"), none.alias("t1"), none.alias("t2"))
    nodes = stored(below.unionByName(root), "nodes")

    # The key of a node's parent is its own without the last turn.
    up = [F.col("depth") - 1, _xor(F.col("k1"), F.col("t1")), _xor(F.col("k2"), F.col("t2"))]
    children = nodes.where("depth > 0").groupBy(*[c.alias(n) for c, n in zip(up, _NODE, strict=True)]) \
        .agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, _NODE, "left").withColumns({
        "n_children": F.coalesce("n_children", none),
        "leaf": F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long"),
        "saves": (F.col("n") - 1) * F.col("words"), "one": F.lit(1).cast("long")})
    nodes = stored(nodes, "counted")
    nodes = totals_before(nodes, ["first"], "depth", {
        "leaves_above": ("sum", "leaf"), "saves_above": ("sum", "saves"), "owned_above": ("sum", "one")})
    nodes = stored(nodes.drop("one"), "owned")

    owned = nodes.groupBy(F.col("first").alias("conv")).agg(
        F.sum("leaf").alias("leaves"), F.sum("saves").alias("saved"))
    held = members.select("conv", *_EDGE).join(owned, "conv") \
        .groupBy(*_EDGE).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    under = _refined(edges.select(*_EDGE, "split", "nodes").join(held, _EDGE), {"leaves": None, "saved": None}, {})
    everything = owned.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")) \
        .where("leaves IS NOT NULL").select(none.alias("depth"), none.alias("k1"), none.alias("k2"), "leaves", "saved")
    under = under.unionByName(everything)

    # An owner's topmost node hangs from another owner's node; below it the owner is its own parent.
    tops = nodes.where("depth > 0 AND owned_above = 0").select(
        *_NODE, *[c.alias(f"up_{n}") for c, n in zip(up, _NODE, strict=True)])
    owners = nodes.select(*[F.col(c).alias(f"up_{c}") for c in _NODE], F.col("first").alias("upper"))
    upper = tops.join(owners, [f"up_{c}" for c in _NODE]).select(*_NODE, "upper")

    last = members.groupBy("conv").agg(F.max(F.struct(
        "block", F.element_at("turns", -1)["pos"].alias("depth"), F.col("d1").alias("k1"),
        F.col("d2").alias("k2"))).alias("at")).select("conv", "at.depth", "at.k1", "at.k2")
    turnless = convs.where("length = 0").select("conv", *[none.alias(c) for c in _NODE])
    digests = _end_digests(stored(last.unionByName(turnless), "ends"))

    out = nodes.join(under, _NODE).join(upper, _NODE, "left").join(digests, _NODE, "left")
    parent = F.when(F.col("depth") > 0, F.coalesce("upper", "first"))
    return out.select(
        F.col("first").alias("conv_id"), "depth", parent.alias("parent_conv_id"), F.col("n").alias("n_convs"),
        "n_children", (F.col("leaves") - F.col("leaves_above")).alias("n_leaves"),
        (F.col("saved") - F.col("saves_above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, period: int = 20, most: int = 4) -> DataFrame:
    """The trie of ``conversations`` (``conv_id, turn, role, text``) with exchanged heads."""
    return prefix_trie(*exchanged_heads(stored(numbered_turns(conversations), "numbered"), period, most))
