"""Bounded samples of labelled rows, and a small logistic regression."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, max_rows: int, seed: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``text, label`` of the ``max_rows`` labelled ids that come first by a seeded hash; of an
    id's texts the first by such a hash, so that there are at most ``max_rows`` rows. An id with
    labels 0 and 1 has label 1; other columns of either table, whatever their names, are ignored.

    The ids are broadcast, so only their texts are shuffled, one per id and task.
    """
    ids = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
           .groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("label"))
           .orderBy(F.xxhash64(F.lit(seed), "__id"), "__id").limit(max_rows))
    texts = docs.select(F.col(id_col).alias("__doc"), F.col(text_col).cast("string").alias("__text"))
    rows = texts.join(F.broadcast(ids), F.col("__doc") == F.col("__id")).select(
        "__id", F.coalesce("__text", F.lit("")).alias("text"), "label")
    first = F.min(F.struct(F.xxhash64(F.lit(seed), "text"), "text"))
    return rows.groupBy("__id", "label").agg(first["text"].alias("text")).select("text", "label")


def sigmoid(z):
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(z, float)))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights (the first is the intercept) of a ridge logistic regression, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1]) * penalty
    ridge[0, 0] = 1e-3
    for _ in range(rounds):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w
