"""Quality classifier (operator 10): a factorisation machine.

A document is a sparse vector: hashed words (counts, damped and brought to length 1) and
dense columns of structure statistics and metadata computed from its text. The score is
``w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``; the pairwise sum is found in linear time
as half of ``sum_f (sum_i v_if x_i)^2 - sum_i (v_if x_i)^2``, then a logistic link gives a
probability. Features of a whole Arrow batch are computed at once from its bytes.

The model is learnt on the driver from at most ``max_rows`` labelled rows (in the order of a
seeded hash), whose sparse features, not texts, are collected; everything is scored over
whole texts. Null and empty texts have no words and zero statistics and are scored as such;
null labels are not learnt from; without labels of both kinds every score is the share of
good labels (0.5 without labels). Repeated rows are scored each, extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, RollingHash, mixed, pieces, row_chunks, stored, utf8_buffer
from .labelled import labelled_sample, sigmoid

#: Buckets of hashed words, and columns of structure statistics.
BUCKETS = 1 << 14
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
STATISTICS = ("log_bytes log_words word_length letters upper digits symbols lines_per_word line_length "
              "distinct_words repeated_lines symbol_ended capital_words one_letter top_word sentence_ends "
              "longest_run entropy").split()


class Featurizer:
    """Sparse word features and structure statistics of buffers of texts."""

    def __init__(self):
        self.hash = RollingHash(1 << 16)

    def __call__(self, buf: np.ndarray, off: np.ndarray):
        """Row offsets into (bucket, value) lists, and a matrix of statistics."""
        n = len(off) - 1
        stats = np.zeros((n, len(STATISTICS)))
        space = _SPACE[buf]
        inner = off[(off > 0) & (off < len(buf))]
        before, after = np.ones(len(buf), bool), np.ones(len(buf), bool)
        before[1:], after[:-1] = space[:-1], space[1:]
        before[inner] = True
        after[inner - 1] = True
        starts, ends = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
        row = np.searchsorted(off, starts, side="right") - 1
        first = np.searchsorted(row, np.arange(n + 1))
        words = np.diff(first)
        sums = self.hash.prefix(_LOWER[buf])
        # the letters of a word: without symbols around it
        words_hash = mixed(self.hash.of(sums, starts, ends))

        def total(flag):
            run = np.concatenate([[0], np.cumsum(flag)])
            return run[off[1:]] - run[off[:-1]]

        def per_row(values):
            run = np.concatenate([[0], np.cumsum(values)])
            return run[first[1:]] - run[first[:-1]]

        size, some = np.maximum(np.diff(off), 1), np.maximum(words, 1)
        letter, upper = _LETTER[buf], (buf >= 65) & (buf <= 90)
        digit, newline = (buf >= 48) & (buf <= 57), buf == 10
        lines = total(newline) + 1
        stats[:, 0], stats[:, 1] = np.log1p(np.diff(off)), np.log1p(words)
        stats[:, 2] = per_row(ends - starts) / some
        stats[:, 3], stats[:, 4], stats[:, 5] = total(letter) / size, total(upper) / size, total(digit) / size
        stats[:, 6] = total(~letter & ~space & ~digit) / size
        stats[:, 7], stats[:, 8] = lines / some, np.log1p(size / lines)
        key = np.stack([row, (words_hash >> np.uint64(1)).view(np.int64)])
        order = np.lexsort((key[1], key[0]))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(key[0][order]) != 0) | (np.diff(key[1][order]) != 0)
        begin = np.flatnonzero(new)
        count, owner = np.diff(np.append(begin, len(order))), key[0][order][begin]
        distinct = np.bincount(owner, minlength=n)
        stats[:, 9] = distinct / some
        stats[:, 10] = self._repeated_lines(buf, off, sums, newline, lines)
        if len(starts):
            last = buf[ends - 1]
            stats[:, 11] = per_row(~_LETTER[last] & ~((last >= 48) & (last <= 57)) & ~np.isin(last, (46, 44))) / some
            stats[:, 12] = per_row(upper[starts] & upper[np.minimum(starts + 1, ends - 1)]) / some
            stats[:, 13] = per_row(ends - starts == 1) / some
            stats[:, 15] = per_row(np.isin(last, (46, 33, 63))) / some
            same = np.zeros(len(starts), bool)
            same[1:] = (words_hash[1:] == words_hash[:-1]) & (row[1:] == row[:-1])
            stats[:, 16] = per_row(same) / some
            np.maximum.at(stats[:, 14], owner, count / some[owner])
            p = count / some[owner]
            stats[:, 17] = np.bincount(owner, -p * np.log(p), minlength=n)
        bucket = (words_hash[order][begin] >> np.uint64(50)).astype(np.int32)
        value = np.log1p(count)
        length = np.sqrt(np.bincount(owner, value * value, minlength=n))
        value = value / np.maximum(length, 1e-9)[owner]
        return np.searchsorted(owner, np.arange(n + 1)), bucket, value, stats

    def _repeated_lines(self, buf, off, sums, newline, lines):
        """Share of each row's lines that stand in it more than once."""
        n, cuts = len(off) - 1, np.flatnonzero(newline)
        row = np.concatenate([np.arange(n), np.searchsorted(off, cuts, side="right") - 1])
        starts = np.concatenate([off[:-1], cuts + 1])
        order = np.lexsort((starts, row))
        row, starts = row[order], starts[order]
        ends = off[row + 1].copy()
        inside = np.flatnonzero(row[1:] == row[:-1])
        ends[inside] = starts[inside + 1] - 1
        h = self.hash.of(sums, starts, ends)
        order = np.lexsort((h, row))
        same = np.zeros(len(order), bool)
        if len(order):
            same[1:] = (np.diff(row[order]) == 0) & (h[order][1:] == h[order][:-1])
        return np.bincount(row[order], same, minlength=n) / lines


def batch_features(column: pa.Array, featurizer: Featurizer):
    """Features of the texts of an Arrow column, a chunk of rows at a time."""
    buf, off = utf8_buffer(column)
    for a, b in row_chunks(off, CHUNK_BYTES):
        yield featurizer(buf[off[a]:off[b]], off[a:b + 1] - off[a])


class FactorisationMachine:
    """Second-order factorisation machine over ``BUCKETS`` sparse and some dense columns."""

    def __init__(self, rank: int = 8, seed: int = 3):
        rng = np.random.default_rng(seed)
        size = BUCKETS + len(STATISTICS)
        self.bias, self.linear = 0.0, np.zeros(size)
        self.factors = rng.normal(0, 0.01, (size, rank))
        self.mean, self.scale = np.zeros(len(STATISTICS)), np.ones(len(STATISTICS))

    def _standard(self, stats):
        return np.clip((stats - self.mean) / self.scale, -4, 4)

    def margin(self, rows, bucket, value, stats):
        """Scores before the link: linear time in the number of non-zero features."""
        dense = self._standard(stats)
        sums, squares = dense @ self.factors[BUCKETS:], dense ** 2 @ self.factors[BUCKETS:] ** 2
        out = self.bias + dense @ self.linear[BUCKETS:]
        if len(bucket):
            n = len(stats)
            owner = np.repeat(np.arange(n), np.diff(rows))
            out = out + np.bincount(owner, self.linear[bucket] * value, minlength=n)
            for f in range(self.factors.shape[1]):
                x = self.factors[bucket, f] * value
                sums[:, f] += np.bincount(owner, x, minlength=n)
                squares[:, f] += np.bincount(owner, x * x, minlength=n)
        return out + 0.5 * (sums ** 2 - squares).sum(axis=1), sums, dense

    def fit(self, rows, bucket, value, stats, y, epochs: int = 12, batch: int = 256, rate: float = 0.02,
            penalty: float = 2e-4, seed: int = 3):
        """Adam on the logistic loss, with a fixed order of batches for a seed."""
        self.mean, self.scale = stats.mean(axis=0), stats.std(axis=0) + 1e-6
        share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
        self.bias = float(np.log(share / (1 - share)))
        size, rank = self.factors.shape
        moments = [np.zeros((size, rank + 1)), np.zeros((size, rank + 1))]
        rng, step = np.random.default_rng(seed), 0
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for a in range(0, len(y), batch):
                pick, step = order[a:a + batch], step + 1
                lengths = np.diff(rows)[pick]
                at = np.repeat(rows[pick] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) \
                    + np.arange(lengths.sum())
                own = np.concatenate([[0], np.cumsum(lengths)])
                b, v = bucket[at], value[at]
                margin, sums, dense = self.margin(own, b, v, stats[pick])
                error = (sigmoid(margin) - y[pick]) / len(pick)
                self.bias -= rate * float(error.sum())
                owner = np.repeat(np.arange(len(pick)), lengths)
                seen, place = np.unique(b, return_inverse=True)
                grad = np.zeros((len(seen) + len(STATISTICS), rank + 1))
                grad[:len(seen), 0] = np.bincount(place, error[owner] * v, minlength=len(seen))
                grad[len(seen):, 0] = dense.T @ error
                for f in range(rank):
                    own_part = self.factors[b, f] * v
                    grad[:len(seen), f + 1] = np.bincount(
                        place, error[owner] * v * (sums[owner, f] - own_part), minlength=len(seen))
                    grad[len(seen):, f + 1] = (dense * error[:, None]).T @ sums[:, f] \
                        - (dense ** 2 * error[:, None]).sum(axis=0) * self.factors[BUCKETS:, f]
                used = np.concatenate([seen, np.arange(BUCKETS, size)])
                now = np.column_stack([self.linear[used], self.factors[used]])
                grad += penalty * now
                moments[0][used] = 0.9 * moments[0][used] + 0.1 * grad
                moments[1][used] = 0.999 * moments[1][used] + 0.001 * grad ** 2
                slope = moments[0][used] / (1 - 0.9 ** step)
                spread = np.sqrt(moments[1][used] / (1 - 0.999 ** step)) + 1e-8
                now = now - rate * slope / spread
                self.linear[used], self.factors[used] = now[:, 0], now[:, 1:]
        return self


def learn(sample: DataFrame, **parameters) -> FactorisationMachine:
    """Fit on ``text, label`` rows (bounded in number); their features go to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        featurizer = Featurizer()
        for batch in pieces(batches, 0):
            buckets, values, stats = [], [], []
            for rows, bucket, value, dense in batch_features(batch.column(0), featurizer):
                for r in range(len(dense)):
                    buckets.append(bucket[rows[r]:rows[r + 1]])
                    values.append(value[rows[r]:rows[r + 1]].astype(np.float32))
                    stats.append(dense[r])
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32())),
                 pa.array(stats, pa.list_(pa.float64())), batch.column(1)], names=["b", "v", "s", "y"])

    found = sample.mapInArrow(run, "b array<int>, v array<float>, s array<double>, y int").toArrow()
    machine = FactorisationMachine()
    y = found["y"].to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        share = min(max(float(y.mean()) if len(y) else 0.5, 1e-3), 1 - 1e-3)
        machine.bias = float(np.log(share / (1 - share)))
        machine.factors[:] = 0
        return machine
    lists = found["b"].combine_chunks()
    rows = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    # the order of rows is not fixed in a cluster, so sort by content
    stats = found["s"].combine_chunks().flatten().to_numpy().reshape(len(y), -1)
    bucket, value = lists.flatten().to_numpy(), found["v"].combine_chunks().flatten().to_numpy().astype(float)
    order = np.lexsort(np.column_stack([y, stats]).T)
    lengths = np.diff(rows)[order]
    at = np.repeat(rows[:-1][order] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) \
        + np.arange(lengths.sum())
    return machine.fit(np.concatenate([[0], np.cumsum(lengths)]), bucket[at], value[at], stats[order], y[order],
                       **parameters)


def quality(docs: DataFrame, machine: FactorisationMachine, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``doc_id, score`` (0 to 1) of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        featurizer = Featurizer()
        for batch in pieces(batches, 1):
            scores = [sigmoid(shared.value.margin(*f)[0]) for f in batch_features(batch.column(1), featurizer)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate([*scores, np.zeros(0)]))], names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def learnt_from(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_rows: int = 12000,
                seed: int = 5, **parameters) -> FactorisationMachine:
    """Learn from at most ``max_rows`` rows of ``labels``, joined with their texts."""
    return learn(stored(labelled_sample(docs, labels, label_col, max_rows, seed), "labelled"), **parameters)
