"""Corpus pipeline: filter, de-duplicate, decontaminate and mix the documents.

Each stage works on all rows that the one before kept, and returns the columns of
``documents`` (the last one returns the mix). Stages are written as Parquet in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import sheltered, stored, table
from ledgerlens.llm.decontaminate import decontaminate
from ledgerlens.llm.mixing import mix_sources
from ledgerlens.llm.queries import learnable_labels
from ledgerlens.llm.simhash_dedup import keep_one
from ledgerlens.llm.suffix_dedup import remove_repeats
from ledgerlens.llm.toxicity import learnt_from, toxicity

#: Documents of this score or more are rejected as toxic.
TOXIC_SCORE = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar does not reject."""
    model = learnt_from(docs, learnable_labels(spark, sf_dir))
    rows, back = sheltered(docs, "doc_id", "text")
    return back(toxicity(rows, *model, extra=True).where(F.col("__score") < TOXIC_SCORE))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints are linked."""
    return keep_one(docs, radius=2, words=3, seed=42)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 200-byte strings that start more than once in the corpus. A
    document stays even if nothing of its text does."""
    out = remove_repeats(docs, length=200)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else out


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in a benchmark window."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), mode="documents")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words to take of each document: 150 % of all words, shared by source weight."""
    return mix_sources(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", cut_repeated_passages),
    ("benchmark decontamination", drop_contaminated),
    ("mixing", mix),
]

#: Several stages have no SQL form; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``, each one stored before the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"stage{k}")
    return docs
