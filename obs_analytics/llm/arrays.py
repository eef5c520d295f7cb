"""Vectorised text helpers for work inside tasks: words, hashes, windows.

Texts stay in Arrow string buffers; words are byte spans of those buffers, so
a word costs a few array elements instead of a Python object. Every helper
works on one bounded slice of rows (``slices``); a single text longer than the
bound is one slice of its own and is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20  # working arrays take up to about 60 times this
U64 = np.uint64
_BASE, _STEP = U64(0x9E3779B97F4A7C15), U64(0xD1342543DE82EF95)

#: Separators of the whitespace word class ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of the word class ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after A-Z are lower-cased).
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null counts as empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text_col: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of a batch with about ``most`` bytes of text each."""
    if batch.num_rows == 0:
        return
    _, offsets = buffers(batch.column(batch.schema.get_field_index(text_col)))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word spans: (starts, ends, first) where ``inside`` marks word bytes per
    byte of data and ``first[i]:first[i + 1]`` are the words of text i."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all bits of a 64-bit value."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _byte_values(seed: int) -> np.ndarray:
    return mixed((np.arange(1, 257, dtype=U64) + U64(256 * seed)) * _BASE)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each span: a polynomial over its bytes, mixed with its length."""
    if len(starts) == 0:
        return np.zeros(0, U64)
    length = ends - starts
    powers = np.cumprod(np.full(int(length.max()), _STEP + U64(2 * seed), U64))
    edges = np.concatenate([[0], np.cumsum(length)])
    within = np.arange(edges[-1]) - np.repeat(edges[:-1], length)
    values = _byte_values(seed)[data[within + np.repeat(starts, length)]] * powers[within]
    return mixed(np.add.reduceat(values, edges[:-1]) + length.astype(U64) * _BASE)


def rolling(hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``width`` consecutive values (runs that cross texts
    included; the caller masks them)."""
    if len(hashes) < width:
        return np.zeros(0, U64)
    n = len(hashes) - width + 1
    out, step = hashes[:n].copy(), _STEP ^ U64(2 * seed)
    for j in range(1, width):
        out *= step
        out += hashes[j : j + n]
    return mixed(out)


def ramp(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c, joined."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def window_starts(first: np.ndarray, width: int) -> np.ndarray:
    """Indices (into the words of the slice) where a whole window starts."""
    n = np.maximum(np.diff(first) - width + 1, 0)
    return np.repeat(first[:-1], n) + ramp(n)


def list_array(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """List array from joined values and the length of each list."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)


def binaries(data: bytes, counts: np.ndarray) -> pa.Array:
    """Binary array from joined bytes and the length of each value."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as signed 64-bit, which is Spark's long."""
    return x.astype(U64).view(np.int64)


def unique_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (a, b), sorted by a, then b."""
    if len(a) and a.min() >= 0 and a.max() < 1 << 16:  # a stable sort of small numbers is a radix sort
        order = np.argsort(b)
        order = order[np.argsort(a[order].astype(np.uint16), kind="stable")]
    else:
        order = np.lexsort((b, a))
    a, b = a[order], b[order]
    keep = np.ones(len(a), bool)
    keep[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[keep], b[keep]
