"""N-gram Jaccard join (operator 12): T-occurrence search with DivideSkip.

A text's set holds the 64-bit hashes of its distinct shingles of five words; two texts are linked
if their sets' Jaccard similarity reaches the threshold. Equal sets count once.

*Document frequencies.* Texts become postings (shingle, text) in chunks; a chunk sends the
shingles of each range of the hash space to one task, each with its texts, as columns of bytes.
The range counts how many chunk texts hold a shingle and sends back the shingles that at least two
hold, with their frequency. So each posting moves once, and only shared ones return.

*Prefixes.* In the order of frequency (rarest first, then by hash), two linked sets of size n and
m share a shingle among the first n - ceil(t n) + 1 of the one and the first m - ceil(t m) + 1 of
the other. A set whose prefix holds no shared shingle has no link and goes no further. Sets that
share prefix shingles, directly or through others, form a family.

*Cells.* A family is dealt by a hash to cells of about ``CELL_POSTINGS`` postings; a family of
that size or less is one cell. In a cell, sets are searched in the order of their sizes by
DivideSkip: of a set's inverted lists, cut to the sizes that may link, the longest are set aside;
the others are merged by a heap that skips what cannot occur often enough, and the candidates are
looked up in the long lists by binary search until they reach the overlap or cannot any more.
Entries that are known to be connected with the set already leave its lists first, and a few that
are left are looked up without a merge, so thousands of near copies of one text cost no more than
some links each.

*Families of several cells.* A set that shares a prefix shingle with sets of another cell which it
is not connected with is searched there too, once per pair of cells: first in one cell for each
shingle, then, after components were put together, wherever it is still not connected.

Links that would join two connected sets are left out; the components are those of all links.
Two shingles of a pair of sets are taken for equal if their hashes are: with 20,000 shingles each
this happens wrongly in 2e-11 of all pairs of sets.

A text without words, or null, has an empty set, is linked with nothing and is its own component;
so is a row without an id, unless it is linked (its component is null if no linked row has an
id). Repeated rows are rows with equal sets. An empty table gives an empty result; other columns
are ignored. Ids are whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RollingHash, mixed, pieces, stored
from .graph import connected_components

#: Bytes of shingles (eight each), and documents, of a chunk at most (a longer text stands alone).
CHUNK_BYTES = 4 << 20
CHUNK_DOCS = 1 << 15
#: Bytes of a text that are hashed at a time.
SLICE_BYTES = 1 << 20
#: Postings of a cell, about.
CELL_POSTINGS = 1 << 20
#: Entries that are looked up in all lists one by one, without a merge.
FEW = 16
#: Weight of a binary search against a step of the merge, for the number of long lists.
MU = 0.0085


def needed(n: int, percent: int) -> int:
    """Shingles that a set of ``n`` must share to be linked: ``percent`` of its size, rounded up."""
    return -(-n * percent // 100)


def prefix_length(n: int, percent: int) -> int:
    return n - needed(n, percent) + 1


def _word_hashes(raw: np.ndarray, hashes: RollingHash) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of a buffer of bytes."""
    raw = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    letter = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.diff(np.concatenate([[False], letter, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return start, end, mixed(hashes.of(hashes.prefix(raw), start, end) ^ (end - start).astype(np.uint64))


def shingle_set(text: bytes, width: int, hashes: RollingHash) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text; of the whole sequence if it has fewer
    than ``width`` words, none if it has no word. Long texts are hashed slice by slice."""
    raw, words, at = np.frombuffer(text, np.uint8), [], 0
    while at < len(raw):
        start, end, found = _word_hashes(raw[at:at + SLICE_BYTES], hashes)
        stop = min(at + SLICE_BYTES, len(raw))
        if stop < len(raw) and len(end) and end[-1] == stop - at:  # the last word may go on
            if len(end) > 1:
                stop, found = at + int(start[-1]), found[:-1]
            else:  # a word longer than a slice is hashed whole
                space = np.flatnonzero(np.isin(raw[stop:], (9, 10, 11, 12, 13, 32)))
                stop = stop + int(space[0]) if len(space) else len(raw)
                found = _word_hashes(raw[at:stop], hashes)[2]
        words.append(found)
        at = stop
    word = np.concatenate(words) if words else np.zeros(0, np.uint64)
    if not len(word):
        return word
    n = min(width, len(word))
    out = np.full(len(word) - n + 1, n, np.uint64)
    for k in range(n):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + word[k:k + len(out)])
    return np.unique(out)


def _planes(values: np.ndarray) -> bytes:
    """Sorted values byte by byte, high bytes first: these compress to almost nothing."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1)[:, ::-1].T).tobytes()


def _values(planes: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, -1).T[:, ::-1]).view(kind).ravel()


_ROW = ("place long, chunk long, number int, doc_id long, n long, sig1 long, sig2 long, "
        "tokens binary, held binary, often binary")
_NAMES = [f.split()[0] for f in _ROW.split(", ")]
_TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r.get(name) for r in rows], _TYPES[f.split()[1]])
         for name, f in zip(_NAMES, _ROW.split(", "), strict=True)], names=_NAMES)


def _batches(rows: Iterator[dict], limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about ``limit`` bytes of shingles."""
    out, size = [], 0
    for r in rows:
        out.append(r)
        size += len(r["tokens"])
        if size >= limit:
            yield _batch(out)
            out, size = [], 0
    if out:
        yield _batch(out)


def _documents(docs: DataFrame, width: int, bits: int, id_col: str, text_col: str,
               chunk_bytes: int) -> DataFrame:
    """Rows of the texts and rows of the postings of a chunk and a range (``place``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, seen, hashes = TaskContext.get().partitionId(), 0, RollingHash(SLICE_BYTES + 1)
        known, sets, size, docs_in = {}, [], 0, 0

        def chunk_id():
            return task << 24 | seen

        def flush():
            if not sets:
                return
            token = np.concatenate(sets)
            held = np.repeat(np.arange(len(sets)), [len(s) for s in sets]).astype(np.uint16)
            order = np.argsort(token, kind="stable")
            token, held = token[order], held[order]
            edge = np.searchsorted(token >> np.uint64(64 - bits), np.arange(1 << bits).astype(np.uint64))
            for place, (a, b) in enumerate(zip(edge, [*edge[1:], len(token)], strict=True)):
                if b > a:
                    yield {"place": place, "chunk": chunk_id(), "tokens": _planes(token[a:b]),
                           "held": _planes(held[a:b])}

        for batch in pieces(batches, 1):
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = shingle_set((text.as_py() or "").encode("utf-8", "replace"), width, hashes)
                # texts pass by the ranges on their way to the chunk, evenly spread over them
                row = {"place": (task * 7919 + docs_in) % (1 << bits), "chunk": chunk_id(), "doc_id": doc_id,
                       "n": len(found), "number": -1}
                if len(found):
                    with np.errstate(over="ignore"):
                        sig = [int(np.add.reduce(mixed(found ^ np.uint64(s))).view(np.int64)) for s in (1, 2)]
                    row |= {"sig1": sig[0], "sig2": sig[1]}
                    if (key := (len(found), *sig)) not in known:
                        known[key] = len(sets)
                        sets.append(found)
                    row["number"] = known[key]
                out.append(row)
                size, docs_in = size + len(found) * 8, docs_in + 1
                if size >= chunk_bytes or docs_in >= CHUNK_DOCS:
                    yield _batch(out)
                    yield from _batches(flush())
                    out, known, sets, size, docs_in, seen = [], {}, [], 0, 0, seen + 1
            if out:
                yield _batch(out)
        yield from _batches(flush())

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, _ROW)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each range: the shingles that at least two sets of all chunks hold, back to their
    chunks, with the binary logarithm of their frequency."""
    def answer(blobs):
        token = [_values(b["tokens"], np.uint64) for b in blobs]
        if not token:
            return
        different, times = np.unique(np.concatenate(token), return_counts=True)
        kept = times > 1
        different, often = different[kept], np.frexp(times[kept])[1].astype(np.uint8)
        for blob, t in zip(blobs, token, strict=True):
            at = np.searchsorted(different, t)
            at[at == len(different)] = 0
            met = different[at] == t if len(different) else np.zeros(len(t), bool)
            if met.any():
                yield {"place": blob["place"], "chunk": blob["chunk"], "tokens": _planes(t[met]),
                       "held": _planes(_values(blob["held"], np.uint16)[met]), "often": often[at[met]].tobytes()}

    place, blobs = None, []
    for batch in batches:
        texts = batch.filter(pc.is_valid(batch.column(_NAMES.index("number"))))
        if len(texts):
            yield texts
        for row in batch.filter(pc.is_null(batch.column(_NAMES.index("number")))).to_pylist():
            if row["place"] != place:
                yield from _batches(answer(blobs))
                place, blobs = row["place"], []
            blobs.append(row)
    yield from _batches(answer(blobs))


_SET = "chunk long, number int, doc_id long, n long, sig1 long, sig2 long, tokens binary, prefix int"


def _assembled(percent: int):
    """Of each chunk: its texts, and its sets with shared shingles in the prefix, with all their
    shared shingles in order."""
    names = [f.split()[0] for f in _SET.split(", ")]
    types = [_TYPES[f.split()[1]] for f in _SET.split(", ")]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                          names=names)

    def sets(chunk, blobs, sizes):
        if not blobs:
            return
        token = np.concatenate([_values(b["tokens"], np.uint64) for b in blobs])
        held = np.concatenate([_values(b["held"], np.uint16) for b in blobs])
        often = np.concatenate([np.frombuffer(b["often"], np.uint8) for b in blobs])
        order = np.lexsort((token, often, held))
        token, held = token[order], held[order]
        first = np.flatnonzero(np.diff(held.astype(np.int64), prepend=-1))
        out = []
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(held)], strict=True):
            n, sig1, sig2 = sizes[int(held[a])]
            shared = prefix_length(n, percent) - (n - (b - a))  # prefix shingles that are shared
            if shared > 0:
                out.append((chunk, int(held[a]), None, n, sig1, sig2, token[a:b].tobytes(), shared))
                if len(out) == 256:
                    yield made(out)
                    out = []
        if out:
            yield made(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, blobs, sizes = None, [], {}
        for batch in batches:
            texts = []
            for r in batch.to_pylist():
                if r["chunk"] != chunk:
                    yield from sets(chunk, blobs, sizes)
                    chunk, blobs, sizes = r["chunk"], [], {}
                if r["number"] is None:
                    blobs.append(r)
                else:
                    texts.append((chunk, r["number"], r["doc_id"], r["n"], r["sig1"], r["sig2"], None, None))
                    sizes[r["number"]] = (r["n"], r["sig1"], r["sig2"])
            if texts:
                yield made(texts)
        yield from sets(chunk, blobs, sizes)

    return run


def shingle_sets(docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id",
                 text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The texts and, of the sets that may have links, the shared shingles; stored. Rows of texts
    have no ``tokens``; ``prefix`` is the number of shared shingles in a set's prefix."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = (4 * partitions - 1).bit_length()  # some ranges for each task, to even them out
    rows = _documents(docs, width, bits, id_col, text_col, chunk_bytes)
    back = rows.repartition(partitions, "place").sortWithinPartitions("place").mapInArrow(_shared, _ROW)
    sets = (back.repartition(partitions, "chunk").sortWithinPartitions("chunk", F.col("number").asc_nulls_last())
            .mapInArrow(_assembled(percent), _SET))
    return stored(sets, "sets")


class Cell:
    """Inverted lists of the sets of a cell, in the order of their sizes, and their components."""

    def __init__(self, ids: list[int], sizes: list[int], tokens: list[np.ndarray], labels: list[int],
                 percent: int):
        self.ids, self.percent = ids, percent
        self.sizes = np.array(sizes, np.int64)
        token = np.concatenate(tokens)
        entry = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
        order = np.argsort(token, kind="stable")  # keeps the entries of a list in order
        self.entry = entry[order]
        token = token[order]
        first = np.flatnonzero(np.diff(token, prepend=token[:1] - np.uint64(1)))
        self.lists = dict(zip(token[first].tolist(), zip(first.tolist(), [*first[1:].tolist(), len(token)],
                                                         strict=True), strict=True))
        self.home: dict[int, int] = {}  # an entry of each label
        for k, label in enumerate(labels):
            self.home.setdefault(label, k)
        self.label = np.array([self.home[x] for x in labels], np.int64)  # component of each entry
        self.parts: dict[int, list[int]] = {}
        for k, c in enumerate(self.label.tolist()):
            self.parts.setdefault(c, []).append(k)
        self.mine = -1

    def unite(self, x: int, y: int) -> int:
        """Component of the entries ``x`` and ``y`` together; the smaller part is renamed."""
        a, b = int(self.label[x]), int(self.label[y])
        if a == b:
            return a
        if len(self.parts[a]) < len(self.parts[b]):
            a, b = b, a
        moved = self.parts.pop(b)
        self.label[moved] = a
        self.parts[a] += moved
        return a

    def links(self, tokens: np.ndarray, size: int, mine: int, low: int, high: int) -> Iterator[int]:
        """Entries of ``low`` .. ``high`` - 1 that a set of ``size`` is linked to, one of each
        component but ``mine`` (-1: none of them); the caller keeps ``self.mine`` up to date while
        it reads."""
        need = needed(size, self.percent)
        lists = []
        for t in tokens.tolist():
            a, b = self.lists.get(t, (0, 0))
            if a < b:
                a, b = a + np.searchsorted(self.entry[a:b], (low, high))
                if a < b:
                    lists.append(self.entry[a:b])
        self.mine, found = mine, -1
        if low < high and self.label[high - 1] != mine and self._reaches(high - 1, 0, lists, need, size):
            yield high - 1  # of near copies, the one of the next size is a good guess
        while len(lists) >= need:
            others = np.flatnonzero(self.label[low:high] != self.mine) + low
            others = others[others > found]
            if len(others) <= FEW:  # too few to merge lists for
                for x in others.tolist():
                    if self.label[x] != self.mine and self._reaches(x, 0, lists, need, size):
                        yield x
                return
            lists = [y[np.searchsorted(y, found + 1):] for y in lists]
            lists = [x for x in (y[self.label[y] != self.mine] for y in lists) if len(x)]
            if len(lists) < need:
                return
            lists.sort(key=len)
            found = self._first(lists, need, size)
            if found is None:
                return
            yield found

    def _first(self, lists: list[np.ndarray], need: int, size: int) -> int | None:
        """The first entry, in their order, that is in enough of the lists (DivideSkip)."""
        from bisect import bisect_left
        from heapq import heapify, heappop, heappush, heapreplace

        aside = min(int(need / (MU * np.log2(max(2, len(lists[-1]))) + 1)), need - 1, len(lists) - 1)
        long, short = lists[len(lists) - aside:], [x.tolist() for x in lists[:len(lists) - aside]]
        least = need - aside  # occurrences in the short lists
        at = [0] * len(short)
        heap = [(x[0], k) for k, x in enumerate(short)]
        heapify(heap)
        while len(heap) >= least:
            top, popped = heap[0][0], []
            while heap and heap[0][0] == top:
                popped.append(heappop(heap)[1])
            if len(popped) >= least:
                if self._reaches(top, len(popped), long, need, size):
                    return top
                for k in popped:
                    at[k] += 1
                    if at[k] < len(short[k]):
                        heappush(heap, (short[k][at[k]], k))
                continue
            # Nothing before the least-th smallest head can occur often enough: skip to it.
            while heap and len(popped) < least - 1:
                popped.append(heappop(heap)[1])
            if not heap:
                return None
            goal = heap[0][0]
            for k in popped:
                at[k] = bisect_left(short[k], goal, at[k])
                if at[k] < len(short[k]):
                    heappush(heap, (short[k][at[k]], k))
        return None

    def _reaches(self, entry: int, found: int, long: list[np.ndarray], need: int, size: int) -> bool:
        """Whether ``entry``, in ``found`` short lists, is in enough of the long ones too."""
        both = size + int(self.sizes[entry])
        need = max(need, -(-self.percent * both // (100 + self.percent)))
        for k, x in enumerate(long):
            if found >= need or found + len(long) - k < need:
                break
            place = int(np.searchsorted(x, entry))
            found += place < len(x) and x[place] == entry
        return found >= need


def _search(percent: int):
    """Links inside cells (rows of ``role`` 0), and of sets of other cells to them (``role`` 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, cell = None, [], None

        def opened(held):
            return Cell([r["set"] for r in held], [r["n"] for r in held],
                        [np.frombuffer(r["tokens"], np.uint64) for r in held], [r["label"] for r in held], percent)

        def inside(held, cell) -> Iterator[tuple[int, int]]:
            for k, r in enumerate(held):
                low = int(np.searchsorted(cell.sizes, needed(r["n"], percent)))
                for found in cell.links(np.frombuffer(r["tokens"], np.uint64), r["n"], int(cell.label[k]), low, k):
                    yield r["set"], cell.ids[found]
                    cell.mine = cell.unite(k, found)

        def across(r, cell) -> Iterator[tuple[int, int]]:
            low = int(np.searchsorted(cell.sizes, needed(r["n"], percent)))
            high = int(np.searchsorted(cell.sizes, r["n"] * 100 // percent, "right"))
            home = cell.home.get(r["label"], -1)  # an entry connected with the set, if one is known
            mine = int(cell.label[home]) if home >= 0 else -1
            for found in cell.links(np.frombuffer(r["tokens"], np.uint64), r["n"], mine, low, high):
                yield r["set"], cell.ids[found]
                home = cell.home.setdefault(r["label"], found)
                cell.mine = cell.unite(home, found)

        def rows(out):
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()),
                                               pa.array([b for _, b in out], pa.int64())], names=["a", "b"])

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if (r["root"], r["sub"]) != key:
                    if held and cell is None:
                        out += inside(held, opened(held)) if len(held) > 1 and held[0]["alone"] else ()
                    key, held, cell = (r["root"], r["sub"]), [], None
                if r["role"] == 0:
                    held.append(r)
                elif held:
                    cell = cell or opened(held)
                    out += across(r, cell)
            if out:
                yield rows(out)
        if held and cell is None and len(held) > 1 and held[0]["alone"]:
            yield rows(list(inside(held, opened(held))))

    return run


def _linked(cells: DataFrame, percent: int) -> DataFrame:
    partitions = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (cells.select("root", "sub", "role", "alone", "set", "n", "label", "tokens")
            .repartition(partitions, "root", "sub").sortWithinPartitions("root", "sub", "role", "n", "set")
            .mapInArrow(_search(percent), "a long, b long").distinct())


def _prefix_postings(sets: DataFrame, keep: list[str]) -> DataFrame:
    """``token`` and the columns ``keep`` of every shared shingle of the sets' prefixes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch.column(1).to_numpy()
            token = [np.frombuffer(t.as_py(), np.int64)[:n] for t, n in zip(batch.column(0), counts.tolist(), strict=True)]
            row = np.repeat(np.arange(len(batch)), [len(t) for t in token])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(token) if token else np.zeros(0, np.int64)),
                 *(batch.column(2 + k).take(pa.array(row)) for k in range(len(keep)))], names=["token", *keep])

    kinds = ", ".join(f"{c} {sets.schema[c].dataType.simpleString()}" for c in keep)
    return sets.select("tokens", "prefix", *keep).mapInArrow(run, f"token long, {kinds}")


def links_between(sets: DataFrame, percent: int = 80, cell_postings: int = CELL_POSTINGS) -> DataFrame:
    """Links ``a, b`` that connect the sets (``set, n, tokens, prefix``) as all links do."""
    postings = stored(_prefix_postings(sets, ["set"]), "prefixes")
    hubs = postings.groupBy("token").agg(F.min("set").alias("hub"), F.max("set").alias("last")).where("hub < last")
    edges = postings.join(hubs, "token").where("set <> hub").select(F.col("set").alias("a"), F.col("hub").alias("b"))
    roots = connected_components(edges.distinct())
    members = roots.select("node", "root").unionByName(
        roots.select(F.col("root").alias("node"), "root").distinct())
    family = sets.join(members, F.col("set") == F.col("node")).drop("node")
    weight = F.ceil(F.sum(F.octet_length("tokens")) / F.lit(8 * cell_postings)).cast("long")
    cells = family.groupBy(F.col("root").alias("__root")).agg(weight.alias("subs"))
    family = family.join(cells, F.col("root") == F.col("__root")).withColumn(
        "sub", F.pmod(F.xxhash64("set", F.lit(5)), F.col("subs")))
    family = stored(family.select("root", "sub", "subs", "set", "n", "tokens", "prefix"), "families")

    entries = family.withColumns({"role": F.lit(0), "alone": F.lit(True), "label": F.col("set")})
    links = stored(_linked(entries, percent), "links")
    spread = stored(family.where("subs > 1"), "spread")
    done = None
    while not spread.isEmpty():  # families of several cells: two rounds, see above
        labels = connected_components(links).select(F.col("node").alias("__node"), F.col("root").alias("__label"))
        now = spread.join(labels, F.col("set") == F.col("__node"), "left") \
            .withColumn("label", F.coalesce("__label", "set")).drop("__node", "__label")
        now = stored(now, "labelled")
        routes = _routes(_prefix_postings(now, ["root", "sub", "set", "n", "label"]), percent)
        if done is None:
            routes = routes.groupBy("token", "set").agg(F.min("to").alias("to")).select("set", "to").distinct()
        else:
            routes = routes.select("set", "to").distinct().join(done, ["set", "to"], "left_anti")
        routes = stored(routes, "routes")
        queries = now.join(routes, "set").withColumns({"sub": F.col("to"), "role": F.lit(1), "alone": F.lit(False)})
        targets = now.withColumns({"role": F.lit(0), "alone": F.lit(False)})
        found = _linked(targets.unionByName(queries.select(*targets.columns)), percent)
        links = stored(links.unionByName(found).distinct(), "links")
        if done is not None:
            break
        done = routes
    return links


def _routes(postings: DataFrame, percent: int) -> DataFrame:
    """``token, set, to``: an earlier cell of the family that holds a set with the same prefix
    shingle, of a size that may link, that is not known to be connected with ``set``."""
    there = postings.groupBy(F.col("root").alias("__root"), F.col("token").alias("__token"), F.col("sub").alias("to")) \
        .agg(F.min("label").alias("__least"), F.max("label").alias("__most"),
             F.min("n").alias("__small"), F.max("n").alias("__large"))
    met = (F.col("root") == F.col("__root")) & (F.col("token") == F.col("__token")) & (F.col("to") < F.col("sub"))
    other = (F.col("__least") != F.col("label")) | (F.col("__most") != F.col("label"))
    fits = (F.col("__small") * percent <= F.col("n") * 100) & (F.col("n") * percent <= F.col("__large") * 100)
    return postings.join(there, met).where(other & fits).select("token", "set", "to")


def jaccard_components(docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id",
                       text_col: str = "text", cell_postings: int = CELL_POSTINGS,
                       chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``id_col``, ``n_shingles`` and ``component_id`` (the smallest id that links of ``percent``
    similarity reach, its own included) of each row."""
    rows = shingle_sets(docs, percent, width, id_col, text_col, chunk_bytes)
    texts, signature = rows.where("tokens IS NULL"), ["n", "sig1", "sig2"]
    active = rows.where("tokens IS NOT NULL").withColumn("set", F.col("chunk") * CHUNK_DOCS + F.col("number"))
    one = active.groupBy(*signature).agg(F.min("set").alias("set"))
    sets = stored(active.join(one.select("set"), "set", "left_semi")
                  .select("set", *signature, "tokens", "prefix"), "active")
    roots = connected_components(links_between(sets, percent, cell_postings)) \
        .select(F.col("node").alias("set"), "root")

    least = texts.where("n > 0").groupBy(*signature).agg(F.min("doc_id").alias("least"))
    named = sets.select("set", *signature).join(roots, "set", "left") \
        .select(*signature, F.coalesce("root", "set").alias("root"))
    least = stored(least.join(named, signature, "left"), "least")
    by_root = least.where("root IS NOT NULL").groupBy("root").agg(F.min("least").alias("of_root"))
    kin, alone = least.where("root IS NOT NULL").join(by_root, "root"), least.where("root IS NULL")
    least = kin.withColumn("least", F.col("of_root")).select(*signature, "least") \
        .unionByName(alone.select(*signature, "least")) \
        .select(*[F.col(c).alias(f"__{c}") for c in signature], F.col("least").alias("component"))
    met = [F.col(c) == F.col(f"__{c}") for c in signature]
    return texts.join(least, met[0] & met[1] & met[2], "left").select(
        F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))
