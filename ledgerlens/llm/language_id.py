"""Language identification (operator 2): compression with per-language dictionaries.

For each language a zstandard raw-content dictionary is made from a bounded sample of its
training texts. A text is encoded with every dictionary; the smallest output names the
language, the margin to the second smallest gives the score, and a margin below
``min_margin`` bytes per 1,000 marks the row as rejected. Narrow margins are decided anew at a
higher compression level.

Texts are normalised to lower-case letters (ASCII other than letters becomes one space) and
encoded whole, in blocks of ``BLOCK_BYTES``, so that a long text does not become its own
dictionary. Null texts and texts without a letter give ``und`` with score 0; ties go to the
smaller name; rows without a language or text are not learnt from; with nothing to learn
from every row is ``und``. Repeated rows are classified each, other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import pieces

UNDETERMINED = "und"
#: Bytes of normalised text that are encoded as one frame.
BLOCK_BYTES = 4096
#: zstandard level for all texts, and the slower one that decides narrow margins anew.
LEVEL, DECIDING_LEVEL = 6, 12
#: A margin below this many bytes, or bytes per 1,000 encoded bytes, is narrow.
NARROW_BYTES, NARROW_MILLE = 4, 10

#: Compressors of one level that a process holds at a time, and bytes that a dictionary has at least.
HELD, LEAST_DICT = 64, 256

_SPACES = bytes(c | 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_LETTER = re.compile(r"[^\W\d_]")


def normalised(text: str) -> bytes:
    return b" ".join(text.encode("utf-8", "replace").translate(_SPACES).split())


def _share(full: int, languages: int, max_languages: int, least: int) -> int:
    """What each language gets of something that ``max_languages`` languages get in ``full``."""
    return full if languages <= max_languages else max(least, full * max_languages // languages)


def training_sample(rows: DataFrame, docs_per_language: int, chars_per_doc: int, max_languages: int,
                    seed: int) -> dict[str, list[bytes]]:
    """Normalised texts per language: the ``docs_per_language`` distinct texts that come first
    by a seeded hash, each cut to ``chars_per_doc`` characters from its middle. Where there are
    more than ``max_languages`` languages they share the texts of so many, at least one each.
    ``rows`` has ``text`` and ``lang``."""
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull()) \
        .select("text", "lang", F.xxhash64(F.lit(seed), "text").alias("h"))
    # copies share one hash
    counts = rows.select("lang", "h").distinct().groupBy("lang").count()
    texts = {r["lang"]: r["count"] for r in counts.collect()}
    if not texts:
        return {}
    wanted = _share(docs_per_language, len(texts), max_languages, 1)
    # hashes below a language's bound hold over four times the texts wanted, so that few are ranked
    bounds = rows.sparkSession.createDataFrame(
        [(n, min(2**63 - 1, 2**64 * (4 * wanted + 64) // k - 2**63)) for n, k in texts.items()],
        StructType([counts.schema["lang"], StructField("bound", LongType())]))
    middle = F.greatest(F.lit(1), (F.length("text") - chars_per_doc) / 2).cast("int")
    drawn = (rows.join(F.broadcast(bounds), "lang").where(F.col("h") <= F.col("bound"))
             .groupBy("lang", "h")  # copies of a text count once
             .agg(F.min(F.substring(F.col("text"), middle, F.lit(chars_per_doc))).alias("text")))
    order = Window.partitionBy("lang").orderBy("h")
    drawn = drawn.withColumn("k", F.row_number().over(order)).where(F.col("k") <= wanted)
    out: dict[str, list[bytes]] = {n: [] for n in sorted(texts)}
    for r in drawn.orderBy("lang", "k").collect():
        if norm := normalised(r["text"]):
            out[r["lang"]].append(norm)
    return {n: texts for n, texts in out.items() if texts}


def _compressor(content: bytes, level: int = LEVEL):
    import zstandard

    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(level=level)
    return zstandard.ZstdCompressor(level=level, dict_data=d, write_checksum=False,
                                    write_content_size=False, write_dict_id=False)


def sizes(norm: bytes, compressors: dict) -> dict[str, int]:
    """Encoded bytes of a normalised text by language."""
    blocks = [norm[i:i + BLOCK_BYTES] for i in range(0, len(norm), BLOCK_BYTES)]
    return {name: sum(len(c.compress(b)) for b in blocks) for name, c in compressors.items()}


def dictionaries(sample: dict[str, list[bytes]], dict_bytes: int) -> dict[str, bytes]:
    """Raw-content dictionaries. Sample texts that another language's first dictionary
    encodes smaller (mislabelled or mixed ones) are left out of the final dictionary."""
    def joined(texts):
        return b"\n".join(texts)[:dict_bytes]

    own: dict[str, list[tuple[int, bytes]]] = {n: [] for n in sample}
    for h in (0, 1):
        encoder = Encoder({n: joined(t[h::2] or t) for n, t in sample.items()}, LEVEL)
        rest = [(n, k, t) for n, texts in sample.items() for k, t in enumerate(texts) if k % 2 != h]
        for (n, k, t), (name, _, _) in zip(rest, encoder.best([t for _, _, t in rest]), strict=True):
            if name == n:
                own[n].append((k, t))
    return {n: joined([t for _, t in sorted(own[n])] or texts) for n, texts in sample.items()}


class Encoder:
    """Compressors of one level for all languages, made in groups of at most ``HELD``."""

    def __init__(self, dicts: dict[str, bytes], level: int):
        names = sorted(dicts)
        self.dicts, self.level, self.kept = dicts, level, None
        self.groups = [names[i:i + HELD] for i in range(0, len(names), HELD)]

    def _tools(self, group: list[str]) -> dict:
        if self.kept is None or len(self.groups) > 1:
            self.kept = None  # the group before goes first
            self.kept = {n: _compressor(self.dicts[n], self.level) for n in group}
        return self.kept

    def best(self, norms: list[bytes]) -> list[tuple[str, int, int]]:
        """Per text the language of the smallest output, its size and the size of the second."""
        found: list[list[tuple[int, str]]] = [[] for _ in norms]
        for group in self.groups if norms else ():
            tools = self._tools(group)
            for k, norm in enumerate(norms):
                found[k] = sorted([*found[k], *((size, n) for n, size in sizes(norm, tools).items())])[:2]
        return [(f[0][1], f[0][0], f[1][0] if len(f) > 1 else f[0][0] * 2 + 16) for f in found]


def identify(docs: DataFrame, dicts: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text",
             min_margin: float = 10.0) -> DataFrame:
    """``id_col``, ``lang_pred``, ``score`` (0 to 1) and ``rejected`` of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(dicts)  # bounded: see language_id

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fast, slow = (Encoder(shared.value, level) for level in (LEVEL, DECIDING_LEVEL))
        for batch in pieces(batches, 1):
            texts = batch.column(1).to_pylist()
            names, scores, narrow = ([x] * len(texts) for x in (UNDETERMINED, 0.0, True))
            rows = [i for i, t in enumerate(texts) if shared.value and t and _LETTER.search(t)]
            # other characters than ASCII letters may be all that normalising leaves out
            norms = [normalised(texts[i]) for i in rows]
            found = fast.best(norms)
            close = [k for k, (_, best, second) in enumerate(found)
                     if 1000 * (second - best) < max(1000 * NARROW_BYTES, NARROW_MILLE * best)]
            for k, again in zip(close, slow.best([norms[k] for k in close]), strict=True):
                found[k] = again
            for i, (name, best, second) in zip(rows, found, strict=True):
                names[i] = name
                scores[i] = 1 - math.exp(-(second - best) / 8)
                narrow[i] = 1000 * (second - best) < min_margin * best
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(narrow, pa.bool_())], names=["id", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double, rejected boolean") \
        .withColumnRenamed("id", id_col)


def language_id(docs: DataFrame, training: DataFrame, docs_per_language: int = 256,
                chars_per_doc: int = 2048, dict_bytes: int = 112 << 10, max_languages: int = 64,
                seed: int = 7, min_margin: float = 10.0, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Learn dictionaries from ``training`` (``text``, ``lang``) and classify ``docs``.

    Every language of ``training`` is learnt. At most ``max_languages * docs_per_language``
    texts of ``chars_per_doc`` characters reach the driver, and ``max_languages * dict_bytes``
    bytes are broadcast: more languages share them, down to one text and ``LEAST_DICT`` bytes
    each. A text is encoded once per language, whatever their number.
    """
    sample = training_sample(training, docs_per_language, chars_per_doc, max_languages, seed)
    dict_bytes = _share(dict_bytes, len(sample), max_languages, LEAST_DICT)
    return identify(docs, dictionaries(sample, dict_bytes), id_col, text_col, min_margin)
