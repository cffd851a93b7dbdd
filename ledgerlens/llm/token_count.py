"""Token counts (operator 9): batch encoding in Arrow functions that return lengths only.

Texts are split at safe boundaries, just before a run of spaces. No piece of the model
holds a space after another character, so no merge crosses such a boundary and the
counts of the parts add up to the count of the whole. Parts are encoded in batches of
about equal bytes; a bounded cache keeps the counts of short parts.

Null and empty texts have 0 bytes and 0 tokens; repeated rows are counted each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of one call to the tokenizer, and entries of a worker's cache of part counts.
BATCH_BYTES = 1 << 18
CACHE_PARTS = 1 << 18
#: Parts longer than this are not cached.
CACHED_CHARS = 48
#: Characters of a text that are split into parts at a time.
SLICE_CHARS = 1 << 20

_PART = re.compile(r" *[^ ]+| +")


def _slices(text: str, limit: int = SLICE_CHARS) -> Iterator[str]:
    """``text`` in slices of about ``limit`` characters that end at safe boundaries."""
    start = 0
    while len(text) - start > limit:
        cut = text.find(" ", start + limit)
        while cut > 0 and text[cut - 1] == " ":
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:] if start else text


def _parts(text: str, first: bool = True) -> list[str]:
    """Parts of ``text`` without the one space that the tokenizer's own prefix restores.

    The first part of a whole text has no such space: the prefix stands before it.
    """
    if first and "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    found = _PART.findall(text)
    keep = 1 if first else 0
    return found[:keep] + [p[1:] if p != " " else p for p in found[keep:]]


def _balanced(parts: list[str], limit: int) -> Iterator[list[str]]:
    batch, size = [], 0
    for p in parts:
        batch.append(p)
        size += len(p) + 1
        if size >= limit:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


def _crosses(processor) -> bool:
    """Whether any piece holds a space mark after another character."""
    pieces = (processor.id_to_piece(i) for i in range(processor.get_piece_size()))
    return any("▁" in p.lstrip("▁") for p in pieces)


def _counter(model_path: str):
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=model_path)
    splits = not _crosses(processor) and _probe(processor)
    cache: dict[str, int] = {}

    def lengths(texts: list[str]) -> list[int]:
        return [len(x) for b in _balanced(texts, BATCH_BYTES)
                for x in processor.encode(b, num_threads=1)]

    def count(text: str | None) -> int:
        if not text:
            return 0
        if not splits:
            return lengths([text])[0]
        text = text.replace("▁", " ")  # the model's own mark of a space
        return sum(of_parts(_parts(s, k == 0)) for k, s in enumerate(_slices(text)))

    def of_parts(parts: list[str]) -> int:
        known = list(map(cache.get, parts))
        missing = [p for p, n in zip(parts, known, strict=True) if n is None]
        total = sum(n for n in known if n)
        if missing:
            if len(cache) > CACHE_PARTS:
                cache.clear()
            distinct = list(dict.fromkeys(missing))
            found = dict(zip(distinct, lengths(distinct), strict=True))
            total += sum(map(found.__getitem__, missing))
            cache.update((p, n) for p, n in found.items() if len(p) <= CACHED_CHARS)
        return total

    return count


def _probe(processor) -> bool:
    """Whether the model adds its prefix and keeps white space, as splitting needs."""
    whole = processor.encode("a  b c ")
    apart = sum((processor.encode(p) for p in _parts("a  b c ")), [])
    return len(whole) == len(apart)


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_bytes`` and ``n_tokens`` of each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = None
        for batch in batches:
            if count is None:
                count = _counter(model_path)
            texts = batch.column(2)
            n = pa.array([count(texts[i].as_py()) for i in range(len(texts))], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n],
                                             names=["id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
                       F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long") \
        .withColumnRenamed("id", id_col)
