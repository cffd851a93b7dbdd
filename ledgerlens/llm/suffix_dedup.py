"""Suffix-array dedup (operator 1): a logarithmic family of sparse suffix arrays.

Every byte that lies in a ``length``-byte string which also starts anywhere else is removed.

*Which suffixes.* A suffix array over all bytes of a large corpus is several times the
corpus. The arrays here are sparse: of the ``k``-byte strings inside each ``length``-byte
window the one with the smallest hash marks a suffix (a minimiser). Equal windows mark the
same suffix, so two equal windows always meet under one key; about one suffix in 85 bytes is
kept. An entry is ordered by the hash of its first ``k`` bytes, then by the hash of its
*stretch*: the bytes of all windows that it marks. Any order that puts equal prefixes
together serves a merge-scan, and this one needs no text to compare.

*Index family.* Batches are added one after another. A batch's suffix array is merge-scanned
with the arrays of all levels: neighbours with one key are long matches. Levels of equal size
are merged into the next one, so an entry is rewritten a logarithmic number of times. The
arrays are runs of one sorted table, bucketed by key, in the shared folder; a batch is
shuffled once, when it is written, and scans and merges read the buckets as they lie.

*What a scan tells.* If another entry has the same key and the same stretch, all windows of
both repeat. If the key repeats but no stretch does, the windows are judged one by one: the
undecided entries, and one entry of each stretch under the same key, are brought together by
key with the bytes of their stretches, and the windows that equal another one are found. A
key with more than ``WIDE`` stretches (a phrase in front of many different texts) is not
brought together: its windows are dealt out by their hashes instead and counted there. Both
ways tell the same; the second takes more room per window and has no group that can grow.

Equality is by 64-bit hashes of stretches and windows within a key (128 bits for windows dealt
out by hash). Work and memory of a task do not depend on the size of a group of copies:
entries are sorted and counted, never paired. Texts are cut in segments of ``CHUNK_BYTES``, so
a long text needs no more memory than its own bytes.

Null texts are empty; texts below ``length`` bytes lose nothing; repeated rows (even of one
id) are texts of their own and remove each other; an empty table gives an empty result;
columns other than the id and the text pass through unchanged. Ids are whole numbers; rows
with a null id are told apart by their texts.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, RollingHash, mixed, pieces, shared_path, sheltered, utf8_buffer

#: Bytes of the strings whose hash picks and orders the suffixes.
K = 32
#: Stretches under one key that one task compares (about 300 bytes each, and 16 bytes for each
#: of some 85 windows), and windows that it sorts at a time.
WIDE = 1 << 17
_SORTED = 1 << 20
_ID = ["__did", "__tid"]


def _slide(op, a: np.ndarray, w: int) -> np.ndarray:
    """op over each run of ``w`` elements of ``a``."""
    done, cur = 1, a
    while 2 * done <= w:
        cur = op(cur[:len(cur) - done], cur[done:])
        done *= 2
    if done < w:
        cur = op(cur[:len(cur) - (w - done)], cur[w - done:])
    return cur


class SuffixPicker:
    """Marks suffixes in buffers of texts."""

    def __init__(self, length: int, k: int = K):
        self.length, self.k, self.width = length, k, length - k + 1
        self.hash = RollingHash(CHUNK_BYTES + length)

    def pick(self, buf: np.ndarray, ends: np.ndarray, starts: int):
        """Entries of the first ``starts`` windows of ``buf``; ``ends`` holds the end of the
        text of each of them. Returns key, stretch, first and last window."""
        none = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        length, k, w = self.length, self.k, self.width
        starts = min(starts, len(buf) - length + 1)
        if starts <= 0:
            return none
        ok = np.arange(starts) + length <= ends[:starts]
        if not ok.any():
            return none
        prefix = self.hash.prefix(buf)
        at = len(prefix) - k
        grams = mixed((prefix[k:] - prefix[:at]) * self.hash.inverse[:at])
        grams[grams == 0] = 1
        least = np.where(ok, _slide(np.minimum, grams, w)[:starts], 0)
        # a gram is picked where it equals the minimum of a window that holds it
        padded = np.concatenate([np.zeros(w - 1, np.uint64), least, np.zeros(w - 1, np.uint64)])
        picked = np.flatnonzero(_slide(np.maximum, padded, w) == grams[:starts + w - 1])
        around = np.lib.stride_tricks.sliding_window_view(padded, w)
        first, last = np.empty(len(picked), np.int64), np.empty(len(picked), np.int64)
        for a in range(0, len(picked), 1 << 14):
            p = picked[a:a + (1 << 14)]
            own = around[p] == grams[p][:, None]
            first[a:a + len(p)] = p - (w - 1) + own.argmax(1)
            last[a:a + len(p)] = p - own[:, ::-1].argmax(1)
        body = self.hash.of(prefix, first, last + length)
        shape = (picked - first).astype(np.uint64) << np.uint64(32) | (last - first).astype(np.uint64)
        return grams[picked], mixed(body ^ mixed(shape)), first, last


def _identity(id_col: str, text_col: str):
    """Columns that name a text, and the text. Texts of one name are equal, but for clashes of
    hashes: among n different texts without an id of 64 and 32 bits together (n * n / 2**97
    pairs are expected), among n different texts of one id of 32 bits (n * n / 2**33)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return (F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text)).alias("__did"),
            F.hash(F.col(id_col), text).alias("__tid"), text.alias("__text"))


def suffix_entries(texts: DataFrame, length: int) -> DataFrame:
    """Entries of the sparse suffix array of ``texts`` (as :func:`_identity` names them): ``key``,
    ``stretch``, the text's id and the first and last window (byte offsets)."""
    names = ["key", "stretch", *_ID, "first", "last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        picker = SuffixPicker(length)
        for batch in pieces(batches, 2):
            buf, off = utf8_buffer(batch.column(2))
            for a in range(0, len(buf), CHUNK_BYTES):
                b = min(a + CHUNK_BYTES, len(buf))
                row = np.searchsorted(off, np.arange(a, b), side="right") - 1
                key, stretch, first, last = picker.pick(buf[a:b + length - 1], off[row + 1] - a, b - a)
                own = row[first]
                start = off[own] - a
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(stretch.view(np.int64)),
                     batch.column(0).take(pa.array(own)), batch.column(1).take(pa.array(own)),
                     pa.array((first - start).astype(np.int32)), pa.array((last - start).astype(np.int32))],
                    names=names)

    return texts.select(*_ID, "__text").mapInArrow(
        run, "key long, stretch long, __did long, __tid int, first int, last int")


class SuffixIndex:
    """The logarithmic family of suffix arrays.

    ``levels`` maps a level to the run that holds it; level n holds ``2 ** n`` batches. The
    ``last`` batch has no level until the next one comes.
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None):
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name, self.path = f"suffixes_{uuid.uuid4().hex}", shared_path(spark, "suffixes")
        self.levels: dict[int, int] = {}
        self.runs, self.last = 0, None

    def _save(self, entries: DataFrame) -> int:
        run, self.runs = self.runs, self.runs + 1
        (entries.withColumn("run", F.lit(run)).write.format("parquet").mode("append")
         .partitionBy("run").bucketBy(self.buckets, "key").sortBy("key", "stretch")
         .option("path", self.path).saveAsTable(self.name))
        return run

    def _read(self, runs: list[int]) -> DataFrame:
        return self.spark.table(self.name).where(F.col("run").isin(runs))

    def settle(self) -> None:
        """Give the last batch a level; levels of equal size are merged: the carry of a counter."""
        if (run := self.last) is None:
            return
        self.last, level = None, 0
        while level in self.levels:
            run = self._save(self._read([run, self.levels.pop(level)]).drop("run"))
            level += 1
        self.levels[level] = run

    def add(self, entries: DataFrame) -> DataFrame:
        """Add a batch's suffix array and merge-scan it with all levels.

        Returns the entries, old and new, under keys of the batch that repeat, with whether
        their stretch repeats (``same``), whether their windows must be judged (``judge``) and
        whether the key has many stretches (``wide``). The batch before gets its level first;
        runs are never changed, so a scan may be read later.
        """
        self.settle()
        self.last = new = self._save(entries.repartition(self.buckets, "key"))
        scan = self._read([new, *self.levels.values()])
        key = Window.partitionBy("key")
        order = key.orderBy("stretch")
        before, after = F.lag("stretch").over(order), F.lead("stretch").over(order)
        scan = (scan
                .withColumn("head", F.coalesce(before != F.col("stretch"), F.lit(True)))
                .withColumn("same", ~F.col("head") | F.coalesce(after == F.col("stretch"), F.lit(False)))
                .withColumn("rows", F.count(F.lit(1)).over(key))
                .withColumn("fresh", F.max(F.col("run") == new).over(key))
                .withColumn("open", F.max(~F.col("same")).over(key))
                .withColumn("wide", F.sum(F.col("head").cast("int")).over(key) > WIDE))
        return (scan.where((F.col("rows") > 1) & F.col("fresh"))
                .withColumn("judge", F.col("open") & F.col("head"))
                .where(F.col("same") | F.col("judge"))
                .select(*_ID, "first", "last", "same", "judge", "wide", "key"))


def _matches(texts: DataFrame, length: int, batches: int) -> DataFrame:
    """Per text with matches: first and last windows of matched stretches (``__same``), and of
    those to judge with their key (``__judge``)."""
    index = SuffixIndex(texts.sparkSession)
    found = None
    for k in range(batches):
        batch = texts if batches == 1 else texts.where(
            F.pmod(F.xxhash64(*_ID), F.lit(batches)) == k)
        part = index.add(suffix_entries(batch, length))
        found = part if found is None else found.unionByName(part)
    return found.groupBy(*_ID).agg(
        F.collect_set(F.when(F.col("same"), F.struct("first", "last"))).alias("__same"),
        F.collect_set(F.when(F.col("judge"), F.struct("key", "wide", "first", "last"))).alias("__judge"))


def _stretches(length: int, wide: bool):
    """mapInArrow function: texts and what to judge -> the bytes of each stretch, by key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 2):
            buf, off = utf8_buffer(batch.column(2))
            rows, keys, firsts, parts = [], [], [], []
            for r, spans in enumerate(batch.column(3).to_pylist()):
                for s in spans:
                    if s["wide"] == wide:
                        rows.append(r)
                        keys.append(s["key"])
                        firsts.append(s["first"])
                        parts.append(buf[off[r] + s["first"]:off[r] + s["last"] + length].tobytes())
            own = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), batch.column(0).take(own), batch.column(1).take(own),
                 pa.array(firsts, pa.int32()), pa.array(parts, pa.binary())],
                names=["key", *_ID, "first", "bytes"])
    return run


def _window_hashes(hashes, parts: list[bytes], length: int):
    """Of all windows of the stretches: the stretch, the place in it, and their hashes."""
    buf = np.frombuffer(b"".join(parts), np.uint8)
    counts = np.array([len(p) - length + 1 for p in parts])
    begin = np.concatenate([[0], np.cumsum([len(p) for p in parts])[:-1]])
    owner = np.repeat(np.arange(len(parts)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = begin[owner] + place
    return owner, place, [h.of(h.prefix(buf), at, at + length) for h in hashes]


def _judged(length: int):
    """mapInArrow function over stretches sorted by key: the windows that repeat in a key."""
    def repeats(hashes, key, did, tid, first, parts):
        key, did, tid, first = (np.array(c, np.int64) for c in (key, did, tid, first))
        found = []
        for a in range(0, len(parts), 1 << 12):
            owner, place, (h,) = _window_hashes(hashes, parts[a:a + (1 << 12)], length)
            owner += a
            found.append((mixed(h ^ mixed(key[owner].view(np.uint64))), owner.astype(np.int32),
                          place.astype(np.int32)))
        h, owner, place = (np.concatenate(c) for c in zip(*found))
        rounds = 1 << max(0, int(len(h) - 1).bit_length() - _SORTED.bit_length() + 1)
        for k in range(rounds):  # by leading bits of the hash
            part = np.arange(len(h)) if rounds == 1 else \
                np.flatnonzero(h >> np.uint64(65 - rounds.bit_length()) == k)
            part = part[np.argsort(h[part])]
            o, at = owner[part], first[owner[part]] + place[part]
            same = h[part][1:] == h[part][:-1]
            # one window may belong to two suffixes of a key: it does not repeat itself
            other = same & ((did[o[1:]] != did[o[:-1]]) | (tid[o[1:]] != tid[o[:-1]]) | (at[1:] != at[:-1]))
            group = np.concatenate([[0], np.cumsum(~same)])
            hit = np.zeros(group[-1] + 1, bool)
            hit[group[1:][other]] = True
            keep = hit[group[:len(part)]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(did[o[keep]]), pa.array(tid[o[keep]].astype(np.int32)),
                 pa.array(at[keep].astype(np.int32))], names=[*_ID, "at"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, waiting = [RollingHash(1 << 16)], [[] for _ in range(5)]
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size > CHUNK_BYTES and row[0] != waiting[0][-1]:
                    yield from repeats(hashes, *waiting)
                    waiting, size = [[] for _ in range(5)], 0
                for c, v in zip(waiting, row):
                    c.append(v)
                size += len(row[4])
        if waiting[0]:
            yield from repeats(hashes, *waiting)
    return run


def _dealt(length: int):
    """mapInArrow function over stretches: two hashes of each of their windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = [RollingHash(1 << 16, 0), RollingHash(1 << 16, 1)]
        for batch in batches:
            first = batch.column(3).to_numpy()
            for a in range(0, batch.num_rows, 1 << 12):
                part = batch.column(4).slice(a, 1 << 12).to_pylist()
                owner, place, (h1, h2) = _window_hashes(hashes, part, length)
                own = pa.array(owner + a)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).take(own), batch.column(2).take(own),
                     pa.array((first[owner + a] + place).astype(np.int32)),
                     pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))],
                    names=[*_ID, "at", "h1", "h2"])
    return run


def _repeated_windows(rows: DataFrame, length: int) -> DataFrame:
    """``__did, __tid, __windows``: of stretches to judge, the windows that stand elsewhere."""
    kind = "key long, __did long, __tid int, first int, bytes binary"
    rows = rows.select(*_ID, "__text", "__judge")
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = (rows.where(F.exists("__judge", lambda s: ~s["wide"])).mapInArrow(_stretches(length, False), kind)
            .repartition(partitions, "key").sortWithinPartitions("key")
            .mapInArrow(_judged(length), "__did long, __tid int, at int"))
    equal = Window.partitionBy("h1", "h2")
    far = (rows.where(F.exists("__judge", lambda s: s["wide"])).mapInArrow(_stretches(length, True), kind)
           .mapInArrow(_dealt(length), "__did long, __tid int, at int, h1 long, h2 long").distinct()
           .withColumn("n", F.count(F.lit(1)).over(equal)).where(F.col("n") > 1).select(*_ID, "at"))
    return near.unionByName(far).groupBy(*_ID).agg(F.collect_set("at").alias("__windows"))


def _joined(spans) -> list[tuple[int, int]]:
    """Spans of whole numbers, both ends included, joined where they touch."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _cut_rows(length: int, names: list[str], keep_text: bool):
    """mapInArrow function: texts with matches -> the bytes left, and figures about them.

    The columns of ``names`` are followed by the stretches found, the single windows found and
    the digest of texts without matches.
    """
    at = names.index("__text")
    same_at, windows_at, sha_at = len(names), len(names) + 1, len(names) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, at):
            buf, off = utf8_buffer(batch.column(at))
            same, windows = batch.column(same_at).to_pylist(), batch.column(windows_at).to_pylist()
            removed, count, sha, left = [], [], batch.column(sha_at).to_pylist(), []
            for r in range(batch.num_rows):
                spans = [(s["first"], s["last"]) for s in same[r] or []] + [(w, w) for w in windows[r] or []]
                found = _joined((a, b + length - 1) for a, b in spans)
                removed.append(sum(b + 1 - a for a, b in found))
                count.append(len(found))
                if keep_text or sha[r] is None:
                    raw, start, parts = buf[off[r]:off[r + 1]], 0, []
                    for a, b in found:
                        parts.append(raw[start:a].tobytes())
                        start = b + 1
                    kept = b"".join([*parts, raw[start:].tobytes()])
                    sha[r] = sha[r] or hashlib.sha256(kept).hexdigest()
                    left.append(kept.decode("utf-8", "ignore") if keep_text else None)
                else:
                    left.append(None)
            columns = [batch.column(k) for k in range(len(names))]
            columns[at] = pa.array(left, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(removed, pa.int64()), pa.array(count, pa.int64()),
                 pa.array(sha, pa.string())], names=[*names, "__removed", "__spans", "__sha"])

    return run


def _stored_by_text(rows: DataFrame) -> DataFrame:
    """``rows`` as a table bucketed by text, so that a join on the text shuffles the other side
    only."""
    spark = rows.sparkSession
    name, path = f"matched_{uuid.uuid4().hex}", shared_path(spark, "matched")
    (rows.write.format("parquet").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), *_ID)
     .option("path", path).saveAsTable(name))
    return spark.table(name)


def _deduplicated(docs: DataFrame, length: int, batches: int, id_col: str, text_col: str,
                  keep_text: bool) -> DataFrame:
    """Columns of ``docs`` without the text, ``__text`` (what is left), ``__bytes``,
    ``__removed``, ``__spans`` and ``__sha``."""
    texts = docs.select(*_identity(id_col, text_col))
    found = _matches(texts, length, batches)
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(*others, *_identity(id_col, text_col)).join(found, _ID, "left")
    hit = F.col("__same").isNotNull()
    text = F.col("__text") if keep_text else F.when(hit, F.col("__text"))
    rows = _stored_by_text(rows.select(
        *others, *_ID, F.octet_length("__text").cast("long").alias("__bytes"),
        F.when(~hit, F.sha2("__text", 256)).alias("__sha"), text.alias("__text"), "__same", "__judge"))
    open_rows = F.coalesce(F.size("__judge"), F.lit(0)) > 0
    windows = _repeated_windows(rows.where(open_rows), length)
    names = [*others, "__bytes", "__text"]
    done = rows.where(~open_rows).withColumn("__windows", F.array().cast("array<int>"))
    rest = rows.where(open_rows).join(windows, _ID, "left")
    columns = [*names, "__same", "__windows", "__sha"]
    kept = rows.select(*names).schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields)
    return done.select(*columns).unionByName(rest.select(*columns)).mapInArrow(
        _cut_rows(length, names, keep_text),
        schema + ", __removed long, __spans long, __sha string")


def repeat_report(docs: DataFrame, length: int = 200, batches: int = 4, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    out = _deduplicated(docs.select(id_col, text_col), length, batches, id_col, text_col, False)
    return out.select(F.col(id_col).alias("doc_id"), F.col("__bytes").alias("n_bytes"),
                      F.col("__removed").alias("n_removed"), F.col("__spans").alias("n_spans"),
                      F.col("__sha").alias("kept_sha256"))


def remove_repeats(docs: DataFrame, length: int = 200, batches: int = 4, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated bytes taken out of the text. Bytes of a character that was
    cut through go as well; a null text stays null."""
    docs, back = sheltered(docs, id_col, text_col)
    out = _deduplicated(docs.withColumn("__null", F.col(text_col).isNull()), length, batches,
                        id_col, text_col, True)
    return back(out.withColumn(text_col, F.when(~F.col("__null"), F.col("__text"))))
