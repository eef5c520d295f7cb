"""Language identification by string kernels (operator 3).

The blended-spectrum presence kernel of two texts counts the byte n-grams of
each order that both hold, divided by the root of their own counts. Kernel
values against a few landmark texts, whitened by the landmarks' own kernel
matrix (Nystroem), feed one-versus-rest kernel ridge regression. Scoring is
two matrix products per batch of texts: n-gram presence by landmarks, kernel
rows by coefficients. Presence is kept in hashed columns, ``COLUMNS`` per
order.

Training reads at most ``per_class`` labelled documents of each language,
whole and as short pieces (so that short texts are recognised too), and is
fitted on the driver; ``landmarks`` of them per language are the landmarks.
Scoring needs no shuffle.

Defined results: a null text or one without a letter is ``und`` with score 0,
as is every text when no labelled row exists; ties go to the language first in
order; repeated rows each give their row; an empty table gives an empty table;
further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obs_analytics.llm import arrays
from obs_analytics.llm.labelled import sample

#: Hashed columns of the n-gram orders 1, 2 and 3.
COLUMNS = (256, 4096, 8192)
UNKNOWN, BATCH = "und", 256
_SPACED = arrays.LOWER.copy()
_SPACED[[b for b in range(128) if not chr(b).isalpha()]] = 0x20  # ASCII other than letters


def presence(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(0/1 matrix of n-gram columns, root of each text's number of them)."""
    every, offsets = arrays.buffers(texts)
    out = np.zeros((len(texts), sum(COLUMNS)), np.float32)
    flat = out.ravel()
    for at in range(0, len(every), arrays.SLICE_BYTES):  # blocks overlap by an n-gram less one byte
        data = _SPACED[every[at : at + arrays.SLICE_BYTES + len(COLUMNS) - 1]].astype(np.int64)
        doc = np.searchsorted(offsets, np.arange(at, at + len(data)), "right") - 1
        base, code = 0, data
        for order, columns in enumerate(COLUMNS, 1):
            if order > 1:
                code = code[:-1] * 256 + data[order - 1 :]
            if len(code) > 0:
                whole = doc[: len(code)] == doc[order - 1 :]
                column = (code * 0x9E3779B1 >> 13) % columns if order > 1 else code
                flat[(doc[: len(code)] * sum(COLUMNS) + base + column)[whole]] = 1
            base += columns
    return out, np.sqrt(np.maximum(out.sum(axis=1), 1))


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray  # presence by landmark, each divided by its root
    weights: np.ndarray  # landmark by language

    def margins(self, texts: pa.Array) -> np.ndarray:
        grams, root = presence(texts)
        return (grams @ self.landmarks.T / root[:, None]) @ self.weights


def fit(texts: list[str], languages: list[str], *, landmarks: int, penalty: float = 0.1) -> Model:
    names = sorted(set(languages))
    own = [[t for t, lang in sorted(zip(texts, languages, strict=True)) if lang == name and t.strip()] for name in names]
    picked, rows, target = [], [], []
    for k, group in enumerate(own):
        step = max(1, len(group) // max(1, landmarks))
        picked += group[::step][:landmarks]
        for t in group:
            middle = len(t) // 2
            pieces = {t, t[middle : middle + 30], t[middle // 2 : middle // 2 + 120]}
            rows += sorted(pieces)
            target += [k] * len(pieces)
    if not picked:
        return Model([], np.zeros((0, sum(COLUMNS)), np.float32), np.zeros((0, 0), np.float32))
    grams, root = presence(pa.array(picked, pa.large_string()))
    marks = grams / root[:, None]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(float))
    keep = values > 1e-6 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    maps = []
    for at in range(0, len(rows), BATCH):
        grams, root = presence(pa.array(rows[at : at + BATCH], pa.large_string()))
        maps.append((grams @ marks.T / root[:, None]) @ whiten)
    x = np.concatenate(maps)
    y = np.where(np.array(target)[:, None] == np.arange(len(names)), 1.0, -1.0)
    inner = np.linalg.solve(x.T @ x + penalty * np.eye(x.shape[1]), x.T @ y)
    return Model(names, marks.astype(np.float32), (whiten @ inner).astype(np.float32))


def train(docs: DataFrame, labels: DataFrame, *, per_class: int = 400, landmarks: int = 50) -> Model:
    """Fit on labelled documents: ``docs`` has doc_id and text, ``labels``
    doc_id and label (the language). The languages are listed on the driver."""
    names = sorted(r.label for r in labels.where("label is not null").select("label").distinct().collect())
    rows = sample(docs, labels, per_class, names).collect() if names else []
    return fit([r.text or "" for r in rows], [r.label for r in rows], landmarks=landmarks)


def identify(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, lang_pred and score, the winning one-versus-rest
    margin moved from -1..1 to 0..1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = docs[text_col]
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.when(text.rlike(r"\p{L}"), text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        names = pa.array([*fitted.languages, UNKNOWN])
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                part = batch.slice(start, BATCH)
                if fitted.languages:
                    margin = fitted.margins(part.column(1))
                    best, value = margin.argmax(axis=1), np.clip((1 + margin.max(axis=1)) / 2, 0, 1).astype(float)
                else:
                    best, value = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows)
                none = part.column(1).is_null().to_numpy(zero_copy_only=False)
                best[none], value[none] = len(fitted.languages), 0.0
                yield pa.RecordBatch.from_arrays([part.column(0), names.take(pa.array(best)), pa.array(value)], names=["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")
