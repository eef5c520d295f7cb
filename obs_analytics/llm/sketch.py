"""Count-min sketch of 64-bit keys, built per partition and merged by block.

A partition's sketch travels as sorted cell numbers and their counts; a merge
task holds the counts of one block of cells at a time, however many partitions
there are. What returns to the driver, and from there to all tasks, is one bit
per cell and threshold: ``depth * cells`` bits for each threshold, a bound that
does not depend on the data. Counts are never too low.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from obs_analytics.llm import arrays

DEPTH, CELLS, BLOCK = 2, 1 << 27, 1 << 20
FLUSH = 1 << 21  # keys that a task gathers before it emits their sketch


def cells_of(keys: np.ndarray, cells: int) -> Iterator[np.ndarray]:
    """The cell of each key in each row of the sketch."""
    for row in range(DEPTH):
        yield arrays.mixed(keys ^ arrays.U64(0xA5A5A5A5 * (row + 1))) & arrays.U64(cells - 1)


def _gaps(values: np.ndarray) -> bytes:
    """Sorted numbers as gaps, byte plane by byte plane (high planes are zeros,
    which the shuffle's compression removes)."""
    return np.diff(values, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _ungaps(coded: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(coded, np.uint8).reshape(4, -1).T).view("<u4").ravel(), dtype=np.int64)


def _partial(keys: list[np.ndarray], cells: int, block: int, most: int) -> pa.RecordBatch:
    blocks, numbers, counts = [], [], []
    for row, found in enumerate(cells_of(np.concatenate(keys), cells)):
        cell, count = np.unique(found, return_counts=True)
        edges = np.searchsorted(cell, np.arange(0, cells + 1, block).astype(arrays.U64))
        low, count = (cell & arrays.U64(block - 1)).astype(np.uint32), np.minimum(count, most).astype(np.uint8)
        for b in np.flatnonzero(np.diff(edges)):
            blocks.append(row * (cells // block) + b)
            numbers.append(_gaps(low[edges[b] : edges[b + 1]]))
            counts.append(count[edges[b] : edges[b + 1]].tobytes())
    return pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(numbers, pa.binary()), pa.array(counts, pa.binary())], names=["block", "cells", "counts"])


def bitmaps(values: DataFrame, keys_of: Callable[[pa.Array], np.ndarray], thresholds: tuple[int, ...], cells: int = CELLS) -> np.ndarray:
    """For each threshold (at most 255) the packed bits, by row, of the cells
    that are counted so often or more. ``values`` has one column; ``keys_of``
    gives the keys to count for a slice of it."""
    is_text = dict(values.dtypes)[values.columns[0]] == "string"
    block, most = min(BLOCK, cells), max(thresholds)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for batch in batches:
            for part in arrays.slices(batch, batch.schema.names[0]) if is_text else [batch]:
                waiting.append(keys_of(part.column(0)))
                n += len(waiting[-1])
                if n > FLUSH:
                    yield _partial(waiting, cells, block, most)
                    waiting, n = [], 0
        if n:
            yield _partial(waiting, cells, block, most)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        for batch in batches:
            for b, numbers, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != now:
                    if now is not None:
                        yield done(now, total)
                    now, total = b, np.zeros(block, np.uint16)
                at = _ungaps(numbers)
                total[at] = np.minimum(total[at] + np.frombuffer(counts, np.uint8), most)
        if now is not None:
            yield done(now, total)

    def done(b: int, total: np.ndarray) -> pa.RecordBatch:
        packed = b"".join(np.packbits(total >= t).tobytes() for t in thresholds)
        return pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([packed], pa.binary())], names=["block", "bits"])

    partial = values.mapInArrow(count, "block int, cells binary, counts binary")
    merged = partial.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block int, bits binary")
    out = np.zeros((len(thresholds), DEPTH * cells // block, block // 8), np.uint8)
    for row in merged.collect():  # the bitmaps' fixed size, in one job
        out[:, row.block] = np.frombuffer(row.bits, np.uint8).reshape(len(thresholds), -1)
    return out.reshape(len(thresholds), DEPTH, cells // 8)


def reaches(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key's count reaches the threshold of one packed bitmap
    (depth rows): never false where the true count does."""
    out = np.ones(len(keys), bool)
    for row, cell in zip(bits, cells_of(keys, 8 * bits.shape[1]), strict=True):
        out &= (row[cell >> arrays.U64(3)] >> (7 - (cell & arrays.U64(7))).astype(np.uint8)) & 1 == 1
    return out
