"""Quality scores by a regularised quadratic discriminant (operator 8).

Every document becomes a short vector of transformed text statistics. Class
means and covariances come from grouped sums over all labelled documents (one
small matrix per task, so nothing is sampled or collected); each covariance is
shrunk towards the pooled one and towards its diagonal. The score is the
logistic of the difference of the classes' Gaussian log-densities plus log
prior odds, from Mahalanobis distances by Cholesky factors that are computed
once and sent to the tasks.

Defined results: null and empty texts have the statistics of an empty text
and a score like any other; labels that are null or without an id teach
nothing, an id with two labels teaches both; with fewer than two labelled
documents of a class every score is the smoothed share of label 1; repeated
rows each give their row; an empty table gives an empty table; further
columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obs_analytics.llm import arrays
from obs_analytics.llm.checkpoints import table

_UPPER, _DIGIT, _LETTER, _MARK, _END = (np.zeros(256, bool) for _ in range(5))
_UPPER[0x41:0x5B] = _DIGIT[0x30:0x3A] = True
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_END[[0x21, 0x2E, 0x3F]] = True
_PLAIN = _MARK.copy()
_PLAIN[[0x2E, 0x2C, 0x27, 0x2D]] = False  # marks other than . , ' -

#: Statistics in the order of the columns of ``statistics``.
NAMES = (
    "log_words", "word_length", "upper", "digits", "odd_marks", "marked_words", "distinct_words", "repeated_neighbours",
    "repeated_pairs", "distinct_lines", "line_words", "ended_lines", "sentence_words", "entropy",
)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _log(x: np.ndarray, least: float = 0.005) -> np.ndarray:
    """Log of a share, level below ``least``."""
    return np.log(x + least)


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of transformed statistics per text."""
    data, offsets = arrays.buffers(texts)
    n = len(texts)
    starts, ends, first = arrays.spans(data, offsets, arrays.SPACE[data] == 0)
    words, size = np.diff(first), np.diff(offsets)
    total = lambda marks: np.diff(np.concatenate([[0], np.cumsum(marks)])[offsets])
    letters, marks = total(_LETTER[data]), total(_PLAIN[data])
    hashes = arrays.span_hashes(arrays.LOWER[data], starts, ends)
    doc = np.repeat(np.arange(n), words)
    kinds = np.bincount(arrays.unique_pairs(doc, hashes)[0], minlength=n)
    same = (doc[1:] == doc[:-1]) if len(doc) else np.zeros(0, bool)
    neighbours = np.bincount(doc[1:][same & (hashes[1:] == hashes[:-1])], minlength=n) if len(doc) else np.zeros(n)
    pairs = arrays.rolling(hashes, 2)[same] if len(doc) > 1 else hashes[:0]
    pair_kinds = np.bincount(arrays.unique_pairs(doc[1:][same], pairs)[0], minlength=n) if len(pairs) else np.zeros(n)
    n_pairs = np.maximum(words - 1, 0)
    last_mark = np.bincount(doc[_PLAIN[data[ends - 1]]], minlength=n) if len(doc) else np.zeros(n)
    line_start, line_end, line_first = arrays.spans(data, offsets, data != 0x0A)
    lines, line_doc = np.diff(line_first), np.repeat(np.arange(n), np.diff(line_first))
    line_kinds = np.bincount(arrays.unique_pairs(line_doc, arrays.span_hashes(data, line_start, line_end))[0], minlength=n)
    ended = np.bincount(line_doc[_END[data[line_end - 1]]], minlength=n) if len(line_doc) else np.zeros(n)
    bytes_of = np.repeat(np.arange(n), size)
    counts = np.bincount(bytes_of * 256 + data, minlength=256 * n).reshape(n, 256)
    p = counts / np.maximum(size, 1)[:, None]
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1)
    return np.stack([
        np.log1p(words), np.log1p(_share(total(arrays.SPACE[data] == 0), words)), _log(_share(total(_UPPER[data]), letters)),
        _log(_share(total(_DIGIT[data]), size)), _log(_share(marks, size)), _log(_share(last_mark, words), 0.02), np.log(_share(kinds, words) + 0.02),
        _log(_share(neighbours, words)), _log(_share(n_pairs - pair_kinds, n_pairs), 0.02), np.log(_share(line_kinds, lines) + 0.05),
        np.log1p(_share(words, lines)), _share(ended, lines), np.log1p(words / (1 + total(_END[data]))), entropy,
    ], axis=1)


@dataclass
class Model:
    """Per class (0, 1): mean, inverse Cholesky factor, and the constant part of
    the log-density plus log prior. ``share`` is used where nothing was learned."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    constants: list[float]
    share: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), self.share)
        dense = [c - 0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) for m, f, c in zip(self.means, self.factors, self.constants, strict=True)]
        return 1 / (1 + np.exp(np.clip(dense[0] - dense[1], -500, 500)))


def fit(counts: np.ndarray, sums: np.ndarray, products: np.ndarray, *, pooled: float = 0.6, diagonal: float = 0.01) -> Model:
    """Model from each class's number of documents, sum of their vectors and sum
    of outer products. Class covariances are shrunk by ``pooled`` towards the
    pooled covariance, then by ``diagonal`` towards their diagonal."""
    share = (counts[1] + 1) / (counts.sum() + 2)
    if counts.min() < 2:
        return Model([], [], [], float(share))
    means = [s / c for s, c in zip(sums, counts, strict=True)]
    own = [p / c - np.outer(m, m) for p, c, m in zip(products, counts, means, strict=True)]
    common = sum(c * o for c, o in zip(counts, own, strict=True)) / counts.sum()
    factors, constants = [], []
    for c, o in zip(counts, own, strict=True):
        cov = (1 - pooled) * o + pooled * common
        cov = (1 - diagonal) * cov + diagonal * np.diag(np.diag(cov)) + 1e-4 * np.eye(len(o))
        lower = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(lower))
        constants.append(float(np.log(c) - np.log(np.diag(lower)).sum()))
    return Model(means, factors, constants, float(share))


def measured(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, x): the statistics of every document, stored once for
    fitting and scoring. text_key is a hash of the text."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(docs[text_col]).alias("text_key"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.slices(batch, "text"):
                x = statistics(part.column(2))
                yield pa.RecordBatch.from_arrays([*part.columns[:2], arrays.list_array(pa.array(x.ravel()), np.full(len(x), x.shape[1]))], names=["doc_id", "text_key", "x"])

    return table(rows.mapInArrow(run, "doc_id long, text_key long, x array<double>"), "statistics")


def train(vectors: DataFrame, labels: DataFrame) -> Model:
    """Fit on all labelled documents. ``vectors`` as from ``measured``, ``labels``
    with doc_id and label (0 or 1)."""
    size = len(NAMES)
    known = labels.select("doc_id", F.col("label").cast("int").alias("label")).where("doc_id is not null and label in (0, 1)").distinct()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + size + size * size))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(-1, size)
            y = batch.column(1).to_numpy()
            for c in (0, 1):
                own = x[y == c]
                total[c] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["label", "sums"])

    sums = vectors.join(known, "doc_id").select("x", "label").mapInArrow(add, "label int, sums array<double>")
    found = np.zeros((2, 1 + size + size * size))
    for row in sums.select("label", F.posexplode("sums").alias("i", "v")).groupBy("label", "i").agg(F.sum("v").alias("v")).collect():
        found[row.label, row.i] = row.v
    return fit(found[:, 0], found[:, 1 : 1 + size], found[:, 1 + size :].reshape(2, size, size))


def score(vectors: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text_key, score) of each row of ``measured``."""
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2).flatten().to_numpy().reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(shared.value.scores(x))], names=["doc_id", "text_key", "score"])

    return vectors.select("doc_id", "text_key", "x").mapInArrow(run, "doc_id long, text_key long, score double")
