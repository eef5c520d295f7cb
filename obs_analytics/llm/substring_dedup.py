"""Substring dedup (operator 1): drop words of passages that start earlier.

A window is ``width`` consecutive words of one text. Pass 1 counts windows in
a Count-min sketch per partition; the partitions' sketches are merged by cell
block, and one bit per cell (counted twice or more) goes back to all tasks.
Pass 2 takes only the windows whose cells all have that bit, finds by exact
grouping where each such window's word sequence starts first, and a last pass
over the texts removes every estimated-repeated window that is not a first.
A sketch never counts too low, so no repeated window is lost.

To keep the sketch small, a window is counted under its anchor: the run of
``width // 2`` words inside it with the smallest hash. Equal windows have
equal anchors at equal offsets, so an anchor is counted at least as often as
each window that it stands for, and there are about ten times fewer anchors.

Bounds: the bitmap sent to all tasks has ``2 * cells`` bits (32 MB at the
default) whatever the input; with many more anchors than cells more windows
reach the exact pass, and the result stays the same. No group is gathered:
exact grouping keeps one smallest (document, start) per window, after each
slice of texts has kept its own smallest before the shuffle. Windows are told apart by 96-bit hashes.

Defined results: a null or empty text has no words and keeps the empty text;
rows without an id come after all others; rows that share an id, and rows
without one, are ordered by the 64-bit hash of their text, so a passage that
several of them share stays in one; of equal rows one keeps its passages, the
others are repeats of it; an empty table gives an empty table; further columns
are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obs_analytics.llm import arrays, sketch

LAST = (1 << 63) - 1  # place of rows without an id


class Windows:
    """Words, windows and anchors of one slice of texts."""

    def __init__(self, texts: pa.Array, width: int) -> None:
        self.data, self.offsets = arrays.buffers(texts)
        self.starts, self.ends, self.first = arrays.spans(self.data, self.offsets, arrays.SPACE[self.data] == 0)
        self.width = width
        self.hashes = arrays.span_hashes(self.data, self.starts, self.ends)
        self.at = arrays.window_starts(self.first, width)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(hash, word index) of the anchor of each window."""
        runs = arrays.rolling(self.hashes, self.width // 2)
        best, where = runs[self.at], self.at.copy()
        for j in range(1, self.width - self.width // 2 + 1):
            other = runs[self.at + j]
            less = other < best
            best[less] = other[less]
            where[less] = self.at[less] + j
        return best, where

    def keys(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """96-bit hash of the windows that start at the given words."""
        second = arrays.span_hashes(self.data, self.starts, self.ends, 1)
        return arrays.rolling(self.hashes, self.width)[at], (arrays.rolling(second, self.width, 1)[at] >> arrays.U64(32)).astype(np.uint32)


def anchor_keys(texts: pa.Array, width: int) -> np.ndarray:
    """Hashes of the distinct anchors (by place) of a slice of texts."""
    hashes, where = Windows(texts, width).anchors()
    new = np.ones(len(where), bool)
    new[1:] = where[1:] != where[:-1]
    return hashes[new]


def estimated_repeated(windows: Windows, bits: np.ndarray) -> np.ndarray:
    """Start words of the windows that the sketch estimates to be repeated."""
    return windows.at[sketch.reaches(bits, windows.anchors()[0])]


def substring_dedup(docs: DataFrame, *, width: int = 20, cells: int = sketch.CELLS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_removed and ``kept``, its words outside
    every window that also starts earlier, joined by one space. Words are runs
    of characters other than ASCII whitespace."""
    spark = docs.sparkSession
    doc_id = docs[id_col].cast("long")
    rows = docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(LAST)).alias("place"), F.xxhash64(docs[text_col]).alias("text_key"), docs[text_col].alias("text"))
    shared = spark.sparkContext.broadcast(sketch.bitmaps(rows.select("text"), lambda texts: anchor_keys(texts, width), (2,), cells)[0])

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for part in arrays.slices(batch, "text"):
                found = Windows(part.column(2), width)
                at = estimated_repeated(found, bits)
                high, low = found.keys(at)
                doc = np.searchsorted(found.first, at, "right") - 1
                place, text_key, start = part.column(0).to_numpy()[doc], part.column(1).to_numpy()[doc], at - found.first[doc]
                order = np.lexsort((start, text_key, place, low, high))
                high, low, place, text_key, start = (x[order] for x in (high, low, place, text_key, start))
                new = np.ones(len(at), bool)
                new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(arrays.signed(high[new])), pa.array(low[new].view(np.int32)), pa.array(place[new]), pa.array(text_key[new]), pa.array(start[new].astype(np.int32))],
                    names=["high", "low", "place", "text_key", "start"],
                )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows ordered by (place, text_key): first the starts that stay there
        (no text), then the texts. Of equal rows the first keeps the starts."""
        bits = shared.value
        now, waiting, served = None, [], False  # the row identity so far, its starts, whether a text took them
        for batch in batches:
            place, key, start = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            is_text = batch.column(2).is_null().to_numpy(zero_copy_only=False)
            if batch.num_rows == 0:
                continue
            new = np.ones(len(place), bool)
            new[1:] = (place[1:] != place[:-1]) | (key[1:] != key[:-1])
            new[0] = now != (place[0], key[0])
            if new[0]:
                waiting, served = [], False
            run = np.cumsum(new)  # 0 is the run that goes on from the batch before
            starts_run, starts_at = run[~is_text], start[~is_text].astype(np.int64)
            if waiting:
                starts_run, starts_at = np.concatenate([np.zeros(len(waiting), np.int64), starts_run]), np.concatenate([waiting, starts_at])
            texts = np.flatnonzero(is_text)
            takes = np.diff(run[texts], prepend=-1) != 0
            if served and len(texts) and run[texts[0]] == 0:
                takes[0] = False
            edges = np.searchsorted(starts_run, [run[texts], run[texts] + 1])
            counts = np.where(takes, edges[1] - edges[0], 0)
            firsts = starts_at[np.repeat(edges[0], counts) + arrays.ramp(counts)]
            now, last = (place[-1], key[-1]), run[-1]
            served = bool(len(texts) and run[texts[-1]] == last) or (served and last == 0)
            waiting = [] if served else starts_at[starts_run == last].tolist()
            own = batch.take(pa.array(texts)).select(["doc_id", "text"])
            own = pa.RecordBatch.from_arrays([*own.columns, arrays.list_array(pa.array(firsts), counts)], names=["doc_id", "text", "firsts"])
            for part in arrays.slices(own, "text"):
                found = Windows(part.column(1), width)
                at = estimated_repeated(found, bits)
                lists = part.column(2)
                held = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
                yield _kept(part.column(0), found, at[~np.isin(at, lists.flatten().to_numpy() + found.first[held])])

    names = ["doc_id", "n_words", "n_removed", "kept"]

    def _kept(ids: pa.Array, found: Windows, again: np.ndarray) -> pa.RecordBatch:
        cover = np.zeros(len(found.starts) + 1, np.int64)
        np.add.at(cover, again, 1)
        np.add.at(cover, again + width, -1)
        left = np.cumsum(cover)[:-1] == 0
        kept_before = np.concatenate([[0], np.cumsum(left)])[found.first]
        words, kept = np.diff(found.first), np.diff(kept_before)
        start, length = found.starts[left], (found.ends - found.starts)[left]
        gap = np.ones(len(start), np.int64)
        gap[kept_before[1:][kept > 0] - 1] = 0  # no space after a document's last word
        to = np.cumsum(length + gap) - length - gap
        out = np.full(int((length + gap).sum()), 0x20, np.uint8)
        step = arrays.ramp(length)
        out[np.repeat(to, length) + step] = found.data[np.repeat(start, length) + step]
        size = np.diff(np.concatenate([[0], np.cumsum(length + gap)])[kept_before])
        text = arrays.binaries(out.tobytes(), size).cast(pa.string())
        return pa.RecordBatch.from_arrays([ids, pa.array(words), pa.array(words - kept), text], names=names)

    found = rows.select("place", "text_key", "text").mapInArrow(starts, "high long, low int, place long, text_key long, start int")
    # the least (place, text_key, start) of each window, one column after another on one exchange
    by_text = found.repartition("high", "low").groupBy("high", "low", "place", "text_key").agg(F.min("start").alias("start"))
    by_place = by_text.groupBy("high", "low", "place").agg(F.min("text_key").alias("text_key"), F.min_by("start", "text_key").alias("start"))
    first = by_place.groupBy("high", "low").agg(F.min("place").alias("place"), F.min_by("text_key", "place").alias("text_key"), F.min_by("start", "place").alias("start"))
    none = lambda kind: F.lit(None).cast(kind)
    both = first.select("place", "text_key", "start", none("long").alias("doc_id"), none("string").alias("text")).union(
        rows.select("place", "text_key", none("int"), "doc_id", F.coalesce("text", F.lit(""))))
    dealt = both.repartition("place", "text_key").sortWithinPartitions("place", "text_key", F.col("start").asc_nulls_last())
    return dealt.mapInArrow(remove, "doc_id long, n_words long, n_removed long, kept string")
