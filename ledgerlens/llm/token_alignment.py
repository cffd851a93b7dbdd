"""Alignment of two tokenizers over a corpus (operator 13): inverted pair bitmaps.

Tokenizer A (byte-level BPE) encodes a space and the text, tokenizer B (pieces) the text, to
which it adds the space itself. Byte offsets where tokens of both end cut the two sequences
into groups; two tokens are linked where their byte ranges overlap.

*Postings.* Documents are numbered inside chunks of about ``CHUNK_TEXT`` bytes. For each pair
of ids that a chunk links, its posting holds bitmaps of the chunk's documents, one for each
binary digit of the number of links (multiplicity planes): a document with five links of a pair
is in planes 0 and 2. A plane is a list of 16-bit numbers, or a bitmap if that is shorter. The
OR of a pair's planes counts its documents, the planes' sizes times their powers of two count
its links; sums over chunks, pre-aggregated, give the corpus-wide counts. The counts then go back
along the postings: joined with their pair's count, the postings of a chunk add it to every
document in their planes. Nothing but postings and one row per document is shuffled.

*Units.* Neither tokenizer joins a letter, digit or sign of ASCII to what stands before the
space in front of it (checked for B when the model is loaded, else whole texts are encoded), so
a text falls into units that are encoded alone. A worker encodes and aligns a distinct unit
once and keeps the result while its table of units is below ``MAX_UNITS``.

Null and empty texts, and texts that either tokenizer does not give back byte for byte, have no
tokens: zeros and an empty digest. Repeated rows and null or repeated ids count each by itself;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, stored

#: Bytes of text, and documents, of a chunk at most (a longer text stands alone).
CHUNK_TEXT = 8 << 20
CHUNK_DOCS = 1 << 15
#: Documents that are split into units together.
PIECE_DOCS = 1 << 12
#: Units that a worker's table holds before it is emptied, which happens between chunks.
MAX_UNITS = 1 << 18
#: Units that are encoded as one text.
JOINED = 256
#: Characters of a text that are split into units at a time.
SLICE_CHARS = 1 << 20

_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _byte_alphabet() -> dict[str, int]:
    """The characters by which a byte-level vocabulary writes bytes: printable bytes of Latin-1
    stand for themselves, the others are numbered from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of, vocabulary = _byte_alphabet(), self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in byte_of for c in token)
            self.bytes_a[i] = bytes(byte_of[c] for c in token) if known else token.encode()
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(names)]
        self.sizes_a = np.array([len(x) for x in self.bytes_a])
        self.sizes_b = np.array([len(x) for x in self.bytes_b])
        self.bits_b = len(self.bytes_b).bit_length()
        self.fast = self._by_rank()
        most = max(len(self.bytes_a), len(self.bytes_b))
        self.written = [f"{i}{sign}" for i in range(most) for sign in ",|;"]
        self.splits = not any("▁" in p.lstrip("▁") for p in names) and self._joins(["a", "b", "c1"])

    @staticmethod
    def held(path_a: str, path_b: str) -> Tokenizers:
        """The tokenizers of these files, loaded once for a worker process: it runs many tasks."""
        import sys

        loaded = sys.modules.setdefault("ledgerlens_loaded_tokenizers", {})
        if (path_a, path_b) not in loaded:
            loaded[path_a, path_b] = Tokenizers(path_a, path_b)
        return loaded[path_a, path_b]

    def _joins(self, parts: list[str]) -> bool:
        """Whether B gives the parts of a text the same pieces alone and together."""
        return self.b.encode(" ".join(parts)) == sum(map(self.b.encode, parts), [])

    def _by_rank(self):
        """A faster encoder of A for ASCII text, if A is a byte-level BPE whose merges make the
        tokens in the order of their ids, so that ids are ranks: then it merges in the same
        order, and ASCII text is cut alike. None otherwise."""
        import json

        import tiktoken

        model = json.loads(self.a.to_str())["model"]
        vocabulary, merges = model["vocab"], model.get("merges", [])
        made = ["".join(m) if not isinstance(m, str) else m.replace(" ", "") for m in merges]
        if model["type"] != "BPE" or [vocabulary.get(m) for m in made] != list(range(256, 256 + len(made))):
            return None
        ranks = {self.bytes_a[i]: i for i in range(256 + len(made))}
        cut = r"'(?:[sdmt]|ll|ve|re)| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
        try:
            return tiktoken.Encoding("a", pat_str=cut, mergeable_ranks=ranks, special_tokens={})
        except ValueError:  # not all single bytes, or not one token for each rank
            return None

    def gives_back(self, text: str, a: list[int], b: list[int]) -> bool:
        whole = b" " + text.encode()
        return b"".join([self.bytes_a[i] for i in a]) == whole and b"".join([self.bytes_b[i] for i in b]) == whole

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        slow = [t for t in texts if self.fast is None or not t.isascii()]
        found = iter(self.a.encode_batch_fast([" " + t for t in slow], add_special_tokens=False))
        a = [next(found).ids if self.fast is None or not t.isascii() else self.fast.encode_ordinary(" " + t)
             for t in texts]
        return a, self.b.encode(texts, num_threads=1)


def slices(text: str, splits: bool, limit: int = SLICE_CHARS) -> Iterator[list[str]]:
    """The units of ``text``, each without the space before it, in lists of about ``limit``
    characters."""
    import re

    if not splits:
        yield [text]
        return
    border, start = re.compile(r"(?<=[^ ]) (?=[!-~])"), 0
    while len(text) - start > limit and (cut := border.search(text, start + limit)):
        yield border.split(text[start:cut.start()])
        start = cut.end()
    yield border.split(text[start:] if start else text)


class _Index(dict):
    """Numbers of units, in the order in which they are first asked for."""

    def __missing__(self, unit: str) -> int:
        self[unit] = number = len(self)
        return number


class Units:
    """Distinct units with their alignment: counts, linked pairs, groups in writing."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.clear()

    def clear(self) -> None:
        self.index = _Index()
        self.groups: list[str] = []
        self.good = np.zeros(0, bool)
        self.counts = np.zeros((0, 4), np.int64)
        self.start = np.zeros(0, np.int64)  # of a unit's pairs
        self.pairs = np.zeros(0, np.int64)  # ids of A and B of each link, packed

    def numbers(self, units: list[str]) -> np.ndarray:
        """Places of ``units`` in the table; new ones are aligned."""
        known = len(self.index)
        found = np.fromiter(map(self.index.__getitem__, units), np.int32, len(units))
        if len(self.index) > known:
            from itertools import islice

            self._align(list(islice(self.index, known, None)))
        return found

    def _encoded(self, new: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Which of ``new`` both tokenizers give back, the tokens of these one after another, and
        the bytes up to the end of each. Units that may stand in a text as they are go through
        the tokenizers as one text, the others alone."""
        t = self.tokenizers
        ascii, plain, rest = [], [], []
        for k, u in enumerate(new):
            if t.splits and u and "!" <= u[0] <= "~" and u[-1] != " ":
                (ascii if u.isascii() else plain).append(k)
            else:
                rest.append(k)
        order, a, b = [], [], []
        while ascii or plain or rest:
            together = [x[k:k + JOINED] for x in (ascii, plain) for k in range(0, len(x), JOINED)]
            together += [[k] for k in rest]
            texts = [" ".join([new[k] for k in units]) for units in together]
            ascii, plain, rest = [], [], []
            for units, text, x, y in zip(together, texts, *t.encode(texts), strict=True):
                if t.gives_back(text, x, y):
                    order += units
                    a += x
                    b += y
                elif len(units) > 1:  # one of them is at fault: each alone
                    rest += units
        size = np.array([len(new[k].encode()) + 1 for k in order], np.int64)
        return np.array(order, np.int64), np.array(a, np.int64), np.array(b, np.int64), np.cumsum(size)

    def _align(self, new: list[str]) -> None:
        t = self.tokenizers
        kept, a, b, border = self._encoded(new)
        end_a, end_b = np.cumsum(t.sizes_a[a]), np.cumsum(t.sizes_b[b])
        in_a = _found(end_b, end_a)
        shared, every = end_b[in_a], np.sort(np.concatenate([end_a, end_b[~in_a]]))
        upto = [np.searchsorted(x, border, "right") for x in (end_a, end_b, shared, every)]
        counts, first = np.zeros((len(new), 4), np.int64), np.zeros(len(new), np.int64)
        counts[kept] = np.column_stack([np.diff(x, prepend=0) for x in upto])
        first[kept] = upto[3] - counts[kept, 3] + len(self.pairs)
        # A stretch between two neighbouring ends lies in one token of either side: a link.
        pairs = a[np.searchsorted(end_a, every)] << t.bits_b | b[np.searchsorted(end_b, every)]
        written = self._written(a, b, np.searchsorted(shared, end_a), np.searchsorted(shared, end_b), len(shared))
        groups, at = [""] * len(new), 0
        for k, stop in zip(kept.tolist(), (upto[0] + upto[1]).tolist(), strict=True):
            groups[k] = "".join(written[at:stop])[:-1]  # without the sign after the last token
            at = stop
        good = np.zeros(len(new), bool)
        good[kept] = True
        self.groups += groups
        self.good = np.concatenate([self.good, good])
        self.counts = np.concatenate([self.counts, counts])
        self.start = np.concatenate([self.start, first])
        self.pairs = np.concatenate([self.pairs, pairs])

    def _written(self, a, b, group_a, group_b, n_groups) -> list[str]:
        """The tokens of all groups in the order of writing, ``a1,`` ``a2|`` ``b1;`` and so on."""
        before_b = np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=n_groups))]).astype(np.int64)
        upto_a = np.cumsum(np.bincount(group_a, minlength=n_groups)).astype(np.int64)
        place_a = np.arange(len(a)) + before_b[group_a]
        place_b = np.arange(len(b)) + upto_a[group_b]
        ids, side = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.int64)
        ids[place_a], ids[place_b] = a, b
        side[place_a], side[place_b] = 2 * group_a, 2 * group_b + 1
        step = np.diff(side, append=side[-1:] + 1)
        sign = np.where(step == 0, 0, 1 + side % 2)
        return list(map(self.tokenizers.written.__getitem__, (3 * ids + sign).tolist()))


def _found(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which ``values`` are in the sorted array ``among``."""
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


class Chunk:
    """Documents of a chunk: which units they hold, how often."""

    def __init__(self, units: Units):
        self.units, self.size, self.docs = units, 0, 0
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, texts: list[str | None]) -> list[tuple[list[int], str]]:
        """Counts and digest of the groups of new documents."""
        splits, out = self.units.tokenizers.splits, []
        parts = [[] if not t or len(t) > SLICE_CHARS else next(slices(t, splits)) for t in texts]
        at = self.units.numbers([u for p in parts for u in p])
        ends = np.cumsum([len(p) for p in parts]).tolist()
        for text, part, end in zip(texts, parts, ends, strict=True):
            if part:
                found = [at[end - len(part):end]]
            else:  # a long text is held by the units it has, not by all its words
                found = map(self.units.numbers, slices(text, splits)) if text else ()
            out.append(self._document(found, len(text or "")))
        return out

    def _document(self, found, size: int) -> tuple[list[int], str]:
        from hashlib import sha256

        number, self.docs = self.docs, self.docs + 1
        units, digest, totals, held = self.units, sha256(), np.zeros(4, np.int64), []
        for at in found:
            if not units.good[at].all():
                held = []
                break
            totals += units.counts[at].sum(axis=0)
            digest.update((";" if held else "").encode() + ";".join([units.groups[k] for k in at.tolist()]).encode())
            held.append(np.unique(at, return_counts=True) if size > SLICE_CHARS else (at, np.ones(len(at), np.int32)))
        if not held:
            return [0, 0, 0, 0], ""
        self.held += [(at, np.full(len(at), number, np.int16), n) for at, n in held]
        self.size += size
        return totals.tolist(), digest.hexdigest()

    def postings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
        """Pairs, their documents, their links, and their bitmaps."""
        empty = np.zeros(0, np.int64)
        if not self.held:
            return empty, empty, empty, pa.array([], pa.binary())
        at, doc, times = (np.concatenate(x) for x in zip(*self.held, strict=True))
        n = self.units.counts[at, 3]
        link = np.arange(n.sum()) + np.repeat(self.units.start[at] - np.cumsum(n) + n, n)
        key = self.units.pairs[link]
        del link
        key <<= 15
        key |= np.repeat(doc, n)
        key, times = _added(key, np.repeat(times, n))
        pair, doc = key >> 15, key & (CHUNK_DOCS - 1)
        own = np.flatnonzero(np.diff(pair, prepend=-1))
        links = np.add.reduceat(times, own)
        bits = self.units.tokenizers.bits_b
        named = pair[own] >> bits << 32 | pair[own] & ((1 << bits) - 1)
        return (named, np.diff(own, append=len(pair)), links,
                planes_of(pair, doc, times, self.docs))


def _added(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their times."""
    single, more = np.sort(key[times == 1]), times > 1
    first = np.flatnonzero(np.diff(single, prepend=-1))
    keys, counts = single[first], np.diff(first, append=len(single))
    if more.any():
        keys, counts = np.concatenate([keys, key[more]]), np.concatenate([counts, times[more]])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        keys, counts = keys[first], np.add.reduceat(counts, first)
    return keys, counts


def planes_of(pair: np.ndarray, doc: np.ndarray, times: np.ndarray, docs: int) -> pa.Array:
    """A binary value for each distinct ``pair`` (sorted): its planes one after another, in
    16-bit units. A plane is its number (256 more if it is a bitmap), the units that follow, and
    these: the documents' numbers, or the bitmap of all ``docs`` documents."""
    digits = [np.flatnonzero(times >> p & 1) for p in range(int(times.max()).bit_length())]
    row = np.concatenate(digits)
    plane = np.repeat(np.arange(len(digits)), [len(d) for d in digits])
    order = np.lexsort((row, plane, pair[row]))
    row, plane = row[order], plane[order]
    run_of = pair[row] * 64 + plane
    begin = np.flatnonzero(np.diff(run_of, prepend=-1))
    n, width = np.diff(begin, append=len(run_of)), -(-docs // 16)
    dense = n > width
    units = np.where(dense, width, n)
    end = np.cumsum(units + 2)
    head = end - units - 2
    out = np.zeros(int(end[-1]), np.uint16)
    out[head] = plane[begin] + 256 * dense
    out[head + 1] = units
    run = np.repeat(np.arange(len(begin)), n)
    number = doc[row]
    sparse = ~dense[run]
    out[(head[run] + 2 + np.arange(len(row)) - begin[run])[sparse]] = number[sparse]
    np.bitwise_or.at(out, (head[run] + 2 + number // 16)[~sparse],
                     (1 << number[~sparse] % 16).astype(np.uint16))
    first = np.flatnonzero(np.diff(pair[row[begin]], prepend=-1))
    offsets = np.append(head[first], len(out)) * 2
    return pa.Array.from_buffers(pa.large_binary(), len(first), [
        None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes())]).cast(pa.binary())


def walk(bits: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The planes of many postings: posting, document and links that the plane stands for, of
    every entry; first the first planes of all postings, then the second ones, and so on."""
    if len(bits) == 0:
        return
    bits = bits.cast(pa.large_binary())
    off = np.frombuffer(bits.buffers()[1], np.int64)[bits.offset:bits.offset + len(bits) + 1]
    data = np.frombuffer(bits.buffers()[2], np.uint8)[off[0]:off[-1]]
    data = np.frombuffer(data.tobytes(), np.uint16)
    at, end = (off[:-1] - off[0]) // 2, (off[1:] - off[0]) // 2
    row = np.flatnonzero(at < end)
    at = at[row]
    while len(row):
        plane, n = data[at].astype(np.int64), data[at + 1].astype(np.int64)
        of = np.repeat(np.arange(len(row)), n)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        value = data[at[of] + 2 + step].astype(np.int64)
        dense = plane[of] >= 256
        weight = np.int64(1) << (plane & 255)
        yield row[of[~dense]], value[~dense], weight[of[~dense]]
        if dense.any():
            of, step, value = of[dense], step[dense], value[dense]
            bit = np.unpackbits(value.astype("<u2").view(np.uint8).reshape(-1, 2), axis=1, bitorder="little")
            word, place = np.nonzero(bit)
            yield row[of[word]], step[word] * 16 + place, weight[of[word]]
        at = at + 2 + n
        left = at < end[row]
        row, at = row[left], at[left]


def _schema(kind: str) -> str:
    counts = ", ".join(f"{c} long" for c in _COUNTS)
    return (f"chunk long, number int, doc_id {kind}, {counts}, groups_sha256 string, "
            "pair long, docs long, links long, bits binary")


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
            chunk_text: int = CHUNK_TEXT) -> DataFrame:
    """The encoded corpus, stored: one row for each document (``number`` in its ``chunk``, counts
    and digest of its groups) and one for each posting (``pair`` of a chunk, its ``docs``,
    ``links`` and ``bits``). The numbers stay as they are, since they are read from what was
    written."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = _schema(rows.schema["doc_id"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), 0
        units = chunk = None
        for batch in (p.slice(k, PIECE_DOCS) for p in pieces(batches, 1) for k in range(0, len(p), PIECE_DOCS)):
            if units is None:
                units = Units(Tokenizers.held(path_a, path_b))
            if chunk is None:
                chunk = Chunk(units)
            first, made = chunk.docs, chunk.add(batch.column(1).to_pylist())
            yield doc_rows(batch.column(0), task << 32 | seen, first, made)
            if chunk.size >= chunk_text or chunk.docs >= CHUNK_DOCS - PIECE_DOCS:
                yield from pair_rows(task << 32 | seen, chunk)
                chunk, seen = None, seen + 1
                if len(units.groups) > MAX_UNITS:
                    units.clear()
        if chunk is not None:
            yield from pair_rows(task << 32 | seen, chunk)

    def doc_rows(ids: pa.Array, chunk_id: int, first: int, made: list) -> pa.RecordBatch:
        n = len(made)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, chunk_id)), pa.array(np.arange(first, first + n), pa.int32()), ids,
             *(pa.array([c[k] for c, _ in made], pa.int64()) for k in range(4)),
             pa.array([d for _, d in made], pa.string()),
             *(pa.nulls(n, pa.int64()) for _ in range(3)), pa.nulls(n, pa.binary())], names=names)

    def pair_rows(chunk_id: int, chunk: Chunk) -> Iterator[pa.RecordBatch]:
        pair, docs, links, bits = chunk.postings()
        for k in range(0, len(pair), 1 << 15):
            part = slice(k, k + (1 << 15))
            n = len(pair[part])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, chunk_id)), pa.nulls(n, pa.int32()), pa.nulls(n, id_type),
                 *(pa.nulls(n, pa.int64()) for _ in range(4)), pa.nulls(n, pa.string()),
                 *(pa.array(x[part]) for x in (pair, docs, links)), bits.slice(k, n)], names=names)

    from pyspark.sql.pandas.types import to_arrow_type

    names = [f.strip().split(" ")[0] for f in schema.split(", ")]
    id_type = to_arrow_type(rows.schema["doc_id"].dataType)
    return stored(rows.mapInArrow(run, schema), "aligned")


def pair_counts(encoded: DataFrame) -> DataFrame:
    """``pair, n_docs, n_links`` of each pair of ids that :func:`aligned` linked, corpus-wide.
    ``pair`` is the id of A times 2**32 and that of B."""
    return encoded.where("pair IS NOT NULL").groupBy("pair").agg(
        F.sum("docs").alias("n_docs"), F.sum("links").alias("n_links"))


def aligned_pairs(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``a, b, n_docs, n_links`` and ``best`` (no pair of this B id has more links)."""
    return _best(pair_counts(aligned(docs, path_a, path_b, id_col, text_col))).select(
        F.shiftright("pair", 32).cast("int").alias("a"), F.col("b").cast("int").alias("b"),
        "n_docs", "n_links", "best")


def _best(pairs: DataFrame) -> DataFrame:
    pairs = pairs.withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))
    most = pairs.groupBy(F.col("b").alias("__b")).agg(F.max("n_links").alias("most"))
    return pairs.join(most, F.col("b") == F.col("__b")).withColumn("best", F.col("n_links") == F.col("most")) \
        .drop("__b", "most")


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
              chunk_text: int = CHUNK_TEXT) -> DataFrame:
    """``id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of each row."""
    encoded = aligned(docs, path_a, path_b, id_col, text_col, chunk_text)
    kind = encoded.schema["doc_id"].dataType.simpleString()
    weights = _best(pair_counts(encoded)).select(F.col("pair").alias("__pair"), "n_links", "best")
    postings = encoded.where("pair IS NOT NULL").select("chunk", "pair", "bits")
    scored = postings.join(weights, F.col("pair") == F.col("__pair")).select(
        "chunk", "bits", F.col("n_links").alias("score"), "best")
    texts = encoded.where("number IS NOT NULL").select(
        "chunk", F.struct("number", "doc_id", *[F.col(c).alias(c) for c in _COUNTS], "groups_sha256").alias("doc"))
    rows = scored.unionByName(texts, allowMissingColumns=True).select("chunk", "bits", "score", "best", "doc.*")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total, best = None, None, None
        for batch in batches:
            chunks = batch.column(0).to_numpy()
            for k in np.flatnonzero(np.diff(chunks, prepend=chunks[0] + 1)).tolist():
                same = batch.slice(k, int(np.searchsorted(chunks[k:], chunks[k], "right")))
                if chunks[k] != at:
                    at = chunks[k]
                    total, best = np.zeros(CHUNK_DOCS, np.int64), np.zeros(CHUNK_DOCS, np.int64)
                # the postings of a chunk come before its documents
                postings = same.slice(0, same.column(4).null_count)
                score = postings.column(2).to_numpy(zero_copy_only=False)
                first = postings.column(3).to_numpy(zero_copy_only=False).astype(np.int64)
                for row, doc, links in walk(postings.column(1)):
                    np.add.at(total, doc, links * score[row])
                    np.add.at(best, doc, links * first[row])
                texts = same.slice(len(postings))
                if len(texts):
                    number = texts.column(4).to_numpy()
                    yield pa.RecordBatch.from_arrays(
                        [*(texts.column(j) for j in range(5, 10)), pa.array(best[number]),
                         pa.array(total[number]), texts.column(10)], names=out)

    out = ["doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256"]
    schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in out[1:-1]) + ", groups_sha256 string"
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(partitions, "chunk").sortWithinPartitions("chunk", F.col("number").asc_nulls_first())
            .mapInArrow(run, schema).withColumnRenamed("doc_id", id_col))
