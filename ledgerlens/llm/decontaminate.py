"""Benchmark decontamination (operator 4): a broadcast hash set of normalised test n-grams.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in
lower case. A window is ``n`` consecutive words of a benchmark item; a shorter item is one
window. Training texts are scanned by word windows as hashes computed for a whole Arrow
batch at once; each hit is verified word by word before it counts.

The set is broadcast in parts of at most ``max_set_bytes`` bytes of item text (a longer item
alone); a larger benchmark takes several scans, each adding its hits to the rows, with the
same result. Null and empty texts have no words and no hits; null and empty items have no
windows; items of one id count once; repeated documents give a row each.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, RollingHash, mixed, pieces, row_chunks, sheltered, utf8_buffer

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_NORMAL = bytes(int(_LOWER[i]) if _IS_WORD[i] else 32 for i in range(256))
#: Bits of the table that is looked up before the sorted hashes.
_FILTER_BITS = 22


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_NORMAL).split()


def windows_of(items: list[tuple[str, str | None]], n: int) -> dict[int, dict[bytes, set[str]]]:
    """Length in words -> window (words joined by spaces) -> ids of its items."""
    out: dict = defaultdict(lambda: defaultdict(set))
    for item_id, text in items:
        words = words_of(text)
        size = min(n, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            out[size][b" ".join(words[i:i + size])].add(item_id)
    return {size: dict(x) for size, x in out.items()}


class WindowScanner:
    """Finds the windows of a hash set in buffers of texts."""

    def __init__(self, windows: dict[int, dict[bytes, set[str]]]):
        self.windows = windows
        self.letters, self.order = RollingHash(1 << 16, 0), RollingHash(1 << 16, 1)
        self.longest = max(windows, default=1)
        self.sets = {}
        for size, found in windows.items():
            joined = [np.frombuffer(w, np.uint8) for w in found]
            hashes = np.concatenate([self._hashes(w, np.array([0, len(w)]), size)[0] for w in joined])
            hashes = np.unique(hashes)
            table = np.zeros(1 << _FILTER_BITS, bool)
            table[hashes >> np.uint64(64 - _FILTER_BITS)] = True
            self.sets[size] = hashes, table

    def _words(self, buf, off):
        mask = _IS_WORD[buf]
        before = np.zeros(len(buf), bool)
        before[1:] = mask[:-1]
        after = np.zeros(len(buf), bool)
        after[:-1] = mask[1:]
        inner = off[(off > 0) & (off < len(buf))]
        before[inner] = False
        after[inner - 1] = False
        return np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1

    def _word_sums(self, buf, starts, ends):
        prefix = self.letters.prefix(_LOWER[buf])
        words = mixed(self.letters.of(prefix, starts, ends))
        order = self.order
        if len(words) + 1 > order.size:
            order._grow(len(words) + 1)
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * order.power[:len(words)], out=sums[1:])
        return sums

    def _grams(self, sums, size):
        n = len(sums) - size
        return mixed((sums[size:] - sums[:n]) * self.order.inverse[:n]) if n > 0 else np.zeros(0, np.uint64)

    def _hashes(self, buf, off, size):
        starts, ends = self._words(buf, off)
        return self._grams(self._word_sums(buf, starts, ends), size), starts

    def scan(self, buf, off):
        """Word starts and ends, the row of each word, whether it is hit, ids found per row."""
        starts, ends = self._words(buf, off)
        row = np.searchsorted(off, starts, side="right") - 1
        hit = np.zeros(len(starts) + 1, np.int32)
        items: dict[int, set[str]] = defaultdict(set)
        if len(starts):
            sums = self._word_sums(buf, starts, ends)
            for size, (hashes, table) in self.sets.items():
                grams = self._grams(sums, size)
                maybe = np.flatnonzero(table[grams >> np.uint64(64 - _FILTER_BITS)])
                maybe = maybe[row[maybe] == row[maybe + size - 1]]
                at = np.minimum(np.searchsorted(hashes, grams[maybe]), len(hashes) - 1)
                for i in maybe[hashes[at] == grams[maybe]]:
                    span = buf[starts[i]:ends[i + size - 1]].tobytes().translate(_NORMAL)
                    ids = self.windows[size].get(b" ".join(span.split()))
                    if ids:
                        hit[i] += 1
                        hit[i + size] -= 1
                        items[int(row[i])] |= ids
        return starts, ends, row, np.cumsum(hit[:-1]) > 0, items

    def rows(self, buf, off, limit: int = CHUNK_BYTES):
        """Per row: starts and ends of its words, which of them are hit, the ids found."""
        for a, b in row_chunks(off, limit):
            if b == a + 1 and off[b] - off[a] > 2 * limit:
                yield self._long_row(buf[off[a]:off[b]], limit)
                continue
            part = off[a:b + 1] - off[a]
            starts, ends, row, hit, items = self.scan(buf[off[a]:off[b]], part)
            first = np.searchsorted(row, np.arange(b - a + 1))
            for r in range(b - a):
                own = slice(first[r], first[r + 1])
                yield starts[own] - part[r], ends[own] - part[r], hit[own], items.get(r, set())

    def _long_row(self, buf, limit):
        """A row longer than a chunk, in parts; the last ``longest - 1`` words before a part are
        put in front of it, however far back they stand."""
        lap, at, found = self.longest - 1, 0, set()
        all_starts, all_ends, all_hit = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        while at < len(buf):
            end = min(at + limit, len(buf))
            while end < len(buf) and _IS_WORD[buf[end]]:
                end += 1
            known = min(lap, len(all_starts))
            words = [buf[a:b].tobytes() for a, b in zip(all_starts[-known:], all_ends[-known:])] if known else []
            before = b"".join(w + b" " for w in words)
            part = np.frombuffer(before + buf[at:end].tobytes(), np.uint8)
            starts, ends, _, hit, items = self.scan(part, np.array([0, len(part)]))
            if known:
                all_hit[-known:] |= hit[:known]
            all_starts = np.concatenate([all_starts, starts[known:] + (at - len(before))])
            all_ends = np.concatenate([all_ends, ends[known:] + (at - len(before))])
            all_hit = np.concatenate([all_hit, hit[known:]])
            found |= items.get(0, set())
            at = end
        return all_starts, all_ends, all_hit, found


def _ranges(starts, ends, hit) -> list[int]:
    """Byte ranges of runs of hit words, as a flat list of starts and ends."""
    if not hit.any():
        return []
    edge = np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    return np.stack([starts[first], ends[last]], 1).ravel().tolist()


def _item_parts(benchmark: DataFrame, id_col: str, text_col: str, max_set_bytes: int):
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                             F.col(text_col).cast("string").alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, math.ceil(total / max_set_bytes))
    for k in range(parts):
        own = items if parts == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == k)
        yield [(r["id"], r["text"]) for r in own.collect()]


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, n: int = 13, id_col: str = "doc_id",
                   text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                   max_set_bytes: int = 16 << 20, prefix: str = "") -> DataFrame:
    """Per row of ``docs``: its columns, ``n_words``, ``n_hit``, ``hit_ranges`` (byte offsets
    of hit runs in the UTF-8 text, flat) and ``item_ids`` (sorted as strings). The new columns
    take the place of columns of their name; ``prefix`` is put before their names."""
    rows = docs.withColumns({f"{prefix}n_words": F.lit(0).cast("long"),
                             f"{prefix}n_hit": F.lit(0).cast("long"),
                             f"{prefix}hit_ranges": F.array().cast("array<int>"),
                             f"{prefix}item_ids": F.array().cast("array<string>")})
    for items in _item_parts(benchmark, item_col, item_text, max_set_bytes):
        rows = _scanned(rows, items, n, text_col, prefix)
    return rows


def _scanned(rows: DataFrame, items: list[tuple[str, str]], n: int, text_col: str, prefix: str) -> DataFrame:
    """``rows`` with the hits of ``items`` added to those of earlier scans."""
    shared = rows.sparkSession.sparkContext.broadcast(items)
    names = rows.columns
    plain = rows.toDF(*[f"c{k}" for k in range(len(names))])  # a name may hold a dot
    text_at, ranges_at, ids_at = (names.index(c) for c in (
        text_col, f"{prefix}hit_ranges", f"{prefix}item_ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = None
        for batch in pieces(batches, text_at):
            scanner = scanner or WindowScanner(windows_of(shared.value, n))
            earlier = zip(batch.column(ranges_at).to_pylist(),
                          batch.column(ids_at).to_pylist(), strict=True)
            words, hits, ranges, ids = [], [], [], []
            for (starts, ends, hit, found), (before, known) in zip(
                    scanner.rows(*utf8_buffer(batch.column(text_at))), earlier, strict=True):
                for a, b in zip(before[::2], before[1::2], strict=True):
                    hit[np.searchsorted(starts, a):np.searchsorted(starts, b)] = True
                words.append(len(starts))
                hits.append(int(hit.sum()))
                ranges.append(_ranges(starts, ends, hit))
                ids.append(sorted({*found, *known}))
            new = {f"{prefix}n_words": pa.array(words, pa.int64()), f"{prefix}n_hit": pa.array(hits, pa.int64()),
                   names[ranges_at]: pa.array(ranges, pa.list_(pa.int32())),
                   names[ids_at]: pa.array(ids, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays(
                [new.get(c, batch.column(k)) for k, c in enumerate(names)], names=[f"c{k}" for k in range(len(names))])

    return plain.mapInArrow(run, plain.schema).toDF(*names)


def _rule(prefix: str, share: int):
    hit, words = F.col(f"{prefix}n_hit"), F.col(f"{prefix}n_words")
    return (hit > 0) & (hit * share >= words)


def contaminated(rows: DataFrame, share: int = 20) -> DataFrame:
    """Add to :func:`benchmark_hits` whether at least one word in ``share`` is hit, and the
    number and digest of the ids found."""
    return (rows.withColumn("n_items", F.size("item_ids").cast("long"))
            .withColumn("items_sha256", F.sha2(F.concat_ws(",", "item_ids"), 256))
            .withColumn("contaminated", _rule("", share)))


def remove_spans(text: str | None, ranges: list[int]) -> str | None:
    """``text`` without the byte ranges."""
    if text is None or not len(ranges):
        return text
    raw, at, out = text.encode("utf-8", "replace"), 0, []
    for a, b in zip(ranges[::2], ranges[1::2], strict=True):
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]]).decode("utf-8", "replace")


def _cut(texts: pd.Series, ranges: pd.Series) -> pd.Series:
    return pd.Series([remove_spans(t, r) for t, r in zip(texts, ranges, strict=True)], dtype=object)


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", n: int = 13,
                  share: int = 20, **columns) -> DataFrame:
    """``docs`` without contaminated documents (``mode="documents"``) or with the hit spans
    of contaminated documents removed (``mode="spans"``)."""
    docs, back = sheltered(docs, columns.get("id_col", "doc_id"), columns.get("text_col", "text"))
    rows, bad = benchmark_hits(docs, benchmark, n, prefix="__", **columns), _rule("__", share)
    if mode == "documents":
        return back(rows.where(~bad))
    if mode != "spans":
        raise ValueError(f"mode {mode!r}: documents or spans")
    text = F.col(columns.get("text_col", "text"))
    cut = F.pandas_udf(_cut, "string")(text, F.col("__hit_ranges"))
    return back(rows.withColumn(columns.get("text_col", "text"), F.when(bad, cut).otherwise(text)))
