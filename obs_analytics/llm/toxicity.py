"""Toxic spans and document scores by a linear-chain CRF (operator 10).

A two-state conditional random field runs over the words of each sentence.
Emissions are sums of feature weights (hashed: the word, its first 3, 4 and 5
bytes, its last 3; and one that all words share), transitions are a 2 x 2
matrix. Training tokens are
labelled from document labels: a word of a toxic document is toxic when the
word or its stem is at least ``ODDS`` times as frequent, by document, in toxic
documents as in clean ones. Forward-backward marginals give each word its
probability; a document's score is a logistic function of their sum and
maximum, and words at 0.5 or more are its offending spans.

Training reads at most ``per_class`` labelled documents of each class and is
fitted on the driver; scoring is one pass over Arrow batches, without a
shuffle, on whole texts. For two states the recursions need only the ratio of
the states' values, so one step is a few array operations over all sentences
that are still running.

Defined results: null and empty texts have no words and get the score of a
document without toxic words; with no labelled rows of a class every score is
the smoothed share of label 1; repeated rows each give their row; an empty
table gives an empty table; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from obs_analytics.llm import arrays
from obs_analytics.llm.labelled import sample

FEATURES = 1 << 18
ODDS, PASSES, RATE, DECAY = 20.0, 30, 0.5, 1e-5
PIECE = 512  # longer sentences are cut for the recursions and joined by products of their steps
_BREAK = np.zeros(256, bool)
_BREAK[[0x0A, 0x21, 0x2E, 0x3F]] = True  # newline ! . ?


@dataclass
class Model:
    weights: np.ndarray  # per feature, for the toxic state
    transitions: np.ndarray  # log weights [before, after]
    document: np.ndarray  # bias, log(1 + sum of marginals), largest marginal


class Words:
    """Words of a slice of texts: spans, features and sentence bounds."""

    def __init__(self, texts: pa.Array) -> None:
        self.data, self.offsets = arrays.buffers(texts)
        low = arrays.LOWER[self.data]
        self.starts, self.ends, self.first = arrays.spans(low, self.offsets, arrays.ALNUM[low])
        n = len(self.starts)
        spans = [(self.starts, self.ends)] + [(self.starts, np.minimum(self.starts + k, self.ends)) for k in (3, 4, 5)] + [(np.maximum(self.ends - 3, self.starts), self.ends)]
        hashed = [(arrays.span_hashes(low, a, b, seed) & arrays.U64(FEATURES - 1)).astype(np.int64) for seed, (a, b) in enumerate(spans)]
        self.features = np.stack([*hashed, np.full(n, FEATURES)], axis=1)
        breaks = np.concatenate([[0], np.cumsum(_BREAK[self.data])])
        opens = np.zeros(n, bool)
        opens[1:] = breaks[self.starts[1:]] > breaks[self.ends[:-1]]
        opens[self.first[:-1][np.diff(self.first) > 0]] = True
        self.sentences = np.append(np.flatnonzero(opens), n)


def marginals(emission: np.ndarray, sentences: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(probability of the toxic state of each word, expected transition counts)
    by forward-backward over all sentences at once, in pieces of ``PIECE`` words."""
    weight, t = np.exp(np.clip(emission, -20, 20)), np.exp(transitions)
    begin, length, inner, before, after = _pieces(weight, sentences, t)
    order = np.argsort(-length, kind="stable")
    begin, length, inner, before, after = (x[order] for x in (begin, length, inner, before, after))
    forward, backward = np.empty(len(emission)), np.ones(len(emission))
    backward[(begin + length - 1)[length > 0]] = after[length > 0]
    steps = int(length[0]) if len(length) else 0
    running = np.searchsorted(-length, -np.arange(steps), "left")  # sentences longer than each step
    for k in range(steps):
        at = begin[: running[k]] + k
        if k == 0:
            r, first = before[: len(at)], ~inner[: len(at)]
            forward[at] = weight[at] * np.where(first, 1, (t[0, 1] + r * t[1, 1]) / (t[0, 0] + r * t[1, 0]))
        else:
            r = forward[at - 1]
            forward[at] = weight[at] * (t[0, 1] + r * t[1, 1]) / (t[0, 0] + r * t[1, 0])
    expected = np.zeros((2, 2))
    for k in range(steps - 1, -1, -1):
        at = begin[: running[k]] + k
        if k == 0:  # the value of the word before is already known
            at = at[inner[: len(at)]]
        x, r = weight[at] * backward[at], forward[at - 1]
        if k > 0:
            backward[at - 1] = (t[1, 0] + t[1, 1] * x) / (t[0, 0] + t[0, 1] * x)
        joint = np.stack([np.full(len(at), t[0, 0]), t[0, 1] * x, t[1, 0] * r, t[1, 1] * r * x])
        expected += (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)
    odds = forward * backward
    return odds / (1 + odds), expected


def _pieces(weight: np.ndarray, sentences: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sentences cut into pieces of up to ``PIECE`` words: (first word, length,
    whether it goes on a sentence, forward ratio before the piece, backward
    ratio at its last word). A piece's steps are one 2 x 2 matrix, so that the
    ratios at its borders follow piece by piece."""
    count = np.maximum(-(-np.diff(sentences) // PIECE), 1)
    begin = np.repeat(sentences[:-1], count) + PIECE * arrays.ramp(count)
    length = np.minimum(np.repeat(sentences[1:], count) - begin, PIECE)
    inner = arrays.ramp(count) > 0
    before, after = np.ones(len(begin)), np.ones(len(begin))
    cut = np.flatnonzero(np.repeat(count, count) > 1)
    if len(cut) == 0:
        return begin, length, inner, before, after
    high, low = np.tile([1.0, 0.0], (len(cut), 1)), np.tile([0.0, 1.0], (len(cut), 1))  # rows of the products
    for k in range(PIECE):
        live = np.flatnonzero(length[cut] > k)
        w = weight[begin[cut[live]] + k][:, None]
        a, b = high[live], low[live]
        opens = ((k == 0) & ~inner[cut[live]])[:, None]
        a, b = np.where(opens, a, t[0, 0] * a + t[1, 0] * b), w * np.where(opens, b, t[0, 1] * a + t[1, 1] * b)
        total = (a + b).sum(axis=1, keepdims=True)
        high[live], low[live] = a / total, b / total
    steps = list(zip(cut.tolist(), inner[cut].tolist(), *high.T.tolist(), *low.T.tolist(), strict=True))
    r = 1.0
    for i, goes_on, a, b, c, d in steps:
        r = before[i] = r if goes_on else 1.0
        r = (c + d * r) / (a + b * r)
    r = 1.0
    for i, goes_on, a, b, c, d in reversed(steps):
        after[i] = r
        r = (b + d * r) / (a + c * r) if goes_on else 1.0
    return begin, length, inner, before, after


def _summary(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per document: 1, log(1 + sum), maximum of its words' marginals."""
    out = np.zeros((len(first) - 1, 3))
    out[:, 0] = 1
    total = np.concatenate([[0], np.cumsum(p)])[first]
    out[:, 1] = np.log1p(np.maximum(np.diff(total), 0))
    some = np.flatnonzero(np.diff(first) > 0)
    if len(some):
        out[some, 2] = np.maximum.reduceat(p, first[some])
    return out


def fit(texts: list[str], toxic: np.ndarray) -> Model:
    """Fit on labelled documents; exact repeats of a text count once."""
    rows = sorted({(t, int(y)) for t, y in zip(texts, toxic, strict=True) if t})
    toxic = np.array([y for _, y in rows], bool)
    share = (toxic.sum() + 1) / (len(toxic) + 2)
    model = Model(np.zeros(FEATURES + 1, np.float32), np.zeros((2, 2)), np.array([np.log(share / (1 - share)), 0, 0]))
    if toxic.all() or not toxic.any():
        return model
    columns, first, sentences = _training_words([t for t, _ in rows])
    doc = np.repeat(np.arange(len(rows)), np.diff(first))
    hot = np.zeros(len(doc), bool)
    for column in (columns[0], columns[2]):  # the word, its first four bytes
        owner, feature = arrays.unique_pairs(doc, column)
        seen = [np.bincount(feature[toxic[owner] == y], minlength=FEATURES) for y in (True, False)]
        odds = ((seen[0] + 0.5) / (toxic.sum() + 1)) / ((seen[1] + 0.5) / ((~toxic).sum() + 1))
        hot |= odds[column] >= ODDS
    y = (hot & toxic[doc]).astype(float)
    inner = np.ones(len(y), bool)
    inner[sentences[:-1]] = False
    at = np.flatnonzero(inner)
    seen_pairs = np.zeros((2, 2))
    np.add.at(seen_pairs, (y[at - 1].astype(int), y[at].astype(int)), 1)
    weights, transitions = np.zeros(FEATURES + 1), np.zeros((2, 2))
    square_w, square_t = np.full(FEATURES + 1, 1e-8), np.full((2, 2), 1e-8)
    for _ in range(PASSES):
        p, expected = marginals(sum(weights[c] for c in columns), sentences, transitions)
        gap = y - p
        slope = sum(np.bincount(c, gap, minlength=FEATURES + 1) for c in columns) - DECAY * len(y) * weights
        square_w += slope**2
        weights += RATE * slope / np.sqrt(square_w)
        slope_t = seen_pairs - expected
        square_t += slope_t**2
        transitions += RATE * slope_t / np.sqrt(square_t)
    p, _ = marginals(sum(weights[c] for c in columns), sentences, transitions)
    return Model(weights.astype(np.float32), transitions, _logistic(_summary(p, first), toxic))


def _training_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature columns, first word of each text, sentence bounds) of all texts,
    gathered slice by slice so that only the features are held at once."""
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], names=["text"])
    columns, first, sentences, n = [], [np.zeros(1, np.int64)], [], 0
    for part in arrays.slices(batch, "text"):
        words = Words(part.column(0))
        columns.append(words.features.T.astype(np.int32))
        first.append(words.first[1:] + n)
        sentences.append(words.sentences[:-1] + n)
        n += len(words.starts)
    return np.concatenate(columns, axis=1), np.concatenate(first), np.append(np.concatenate(sentences), n)


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Ridge logistic regression by Newton steps (the bias is not penalised)."""
    beta, ridge = np.zeros(x.shape[1]), penalty * np.diag([0.0] + [1.0] * (x.shape[1] - 1))
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(x.shape[1])
        beta = beta + np.linalg.solve(hessian, x.T @ (y - p) - ridge @ beta)
    return beta


def train(docs: DataFrame, labels: DataFrame, *, per_class: int = 1500) -> Model:
    """Fit on up to ``per_class`` documents of each class. ``docs`` has doc_id
    and text, ``labels`` doc_id and label (0 or 1)."""
    rows = sample(docs, labels, per_class, [0, 1]).collect()
    model = fit([r.text or "" for r in rows], np.array([r.label for r in rows]))
    held = {r.label: r["count"] for r in labels.where("doc_id is not null").distinct().groupBy("label").count().collect()}
    drawn = [sum(r.label == y for r in rows) for y in (0, 1)]
    if all(drawn):  # the sample's shares of the classes back to those of all labels
        model.document[0] += np.log(held[1] / held[0]) - np.log(drawn[1] / drawn[0])
    return model


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, score, and ``spans``: start, end (characters, half
    open) and probability of each word tagged toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            for part in arrays.slices(batch, "text"):
                words = Words(part.column(1))
                emission = np.zeros(len(words.starts))
                for column in words.features.T:
                    emission += fitted.weights[column]
                p, _ = marginals(emission, words.sentences, fitted.transitions)
                value = 1 / (1 + np.exp(-_summary(p, words.first) @ fitted.document))
                hot = np.flatnonzero(p >= 0.5)
                doc = np.searchsorted(words.first, hot, "right") - 1
                char = np.cumsum((words.data & 0xC0) != 0x80) - 1 if len(hot) else np.zeros(0, np.int64)
                before = char[words.offsets[doc]] if len(hot) else char
                spans = pa.StructArray.from_arrays(
                    [pa.array((char[words.starts[hot]] - before).astype(np.int32)), pa.array((char[words.ends[hot] - 1] + 1 - before).astype(np.int32)), pa.array(p[hot])],
                    names=["start", "end", "p"],
                )
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(value), arrays.list_array(spans, np.bincount(doc, minlength=part.num_rows))], names=["doc_id", "score", "spans"])

    return rows.mapInArrow(run, "doc_id long, score double, spans array<struct<start: int, end: int, p: double>>")
