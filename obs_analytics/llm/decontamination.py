"""Benchmark decontamination (operator 9): a positional inverted index.

``build_index`` stores the postings of the training tokens in the shared
folder, sharded by document: each row holds, for a small block of whole
documents, its terms, the number of their postings and the word positions,
sorted by term and position. ``search`` runs a bounded set of test phrases
against every shard. It starts from the phrase's rarest term in the shard,
shifts its positions by the term's offset, and intersects them with the next
rarest term's list, and so on, which leaves exact phrase matches; with
``slack`` each further term may lie up to so many words off its place
(proximity matches). A document lies in one shard, so nothing is shuffled.

Bounds: one shard holds about ``SHARD_BYTES`` of text or one longer document.
The phrases are a table of distinct (window, item) pairs, dealt by hash into
blocks of about ``QUERY_BYTES`` of term hashes and ids, whatever the length of
an item; the driver holds one block at a time, as arrays, and sends it to all
tasks. Several blocks read the index once each. Terms are 64-bit hashes.

Defined results: null and empty texts have no words, no windows and no hits;
repeated rows of documents each give their row, repeated items count once;
items without an id mark hits but are not listed; empty tables give no hits
or an empty table; further columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obs_analytics.llm import arrays
from obs_analytics.llm.checkpoints import table

SHARD_BYTES, QUERY_BYTES = 512 << 10, 32 << 20
WINDOW_ROWS = 1 << 16  # windows in one batch of their table
INDEX_SCHEMA = "doc_ids array<long>, keys array<long>, first array<int>, terms binary, counts binary, positions binary"


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(term hash of each word, first word of each text). Words are runs of
    ASCII letters (lower-cased), digits and non-ASCII characters."""
    data, offsets = arrays.buffers(texts)
    data = arrays.LOWER[data]
    starts, ends, first = arrays.spans(data, offsets, arrays.ALNUM[data])
    return arrays.span_hashes(data, starts, ends), first


@dataclass
class Phrases:
    """Distinct windows of a block, as term numbers by offset (-1 after the end
    of a short window), and the items that hold window w:
    ``items[first[w]:first[w + 1]]``."""

    vocabulary: np.ndarray
    terms: np.ndarray
    lengths: np.ndarray
    first: np.ndarray
    items: np.ndarray


def windows(items: DataFrame, window: int) -> DataFrame:
    """The distinct (item_id, terms) of items (columns item_id, text), stored:
    the term hashes of each window, those of all words for a shorter item."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.slices(batch, "text"):
                hashes, first = terms_of(part.column(1))
                size = np.diff(first)
                short = np.flatnonzero((size > 0) & (size < window))
                start = np.concatenate([arrays.window_starts(first, window), first[short]])
                length = np.concatenate([np.full(len(start) - len(short), window), size[short]])
                owner = np.searchsorted(first, start, "right") - 1
                for at in range(0, len(start), WINDOW_ROWS):
                    s, n = start[at : at + WINDOW_ROWS], length[at : at + WINDOW_ROWS]
                    data = hashes[np.repeat(s, n) + arrays.ramp(n)].astype("<u8").tobytes()
                    ids = part.column(0).take(pa.array(owner[at : at + WINDOW_ROWS]))
                    yield pa.RecordBatch.from_arrays([ids, arrays.binaries(data, 8 * n)], names=["item_id", "terms"])

    return table(items.mapInArrow(cut, "item_id long, terms binary").distinct(), "windows")


def phrases(block: DataFrame, window: int) -> Phrases:
    """A block of the windows table, collected: the caller has bounded it."""
    found = block.select("item_id", "terms").toArrow().combine_chunks()
    coded = found.column("terms").to_pylist()
    size = np.fromiter(map(len, coded), np.int64, len(coded)) // 8
    hashes = np.frombuffer(b"".join(coded), "<u8").astype(arrays.U64)
    del coded
    vocabulary = np.unique(hashes)
    terms = np.full((len(size), window), -1, np.int64)
    terms[np.repeat(np.arange(len(size)), size), arrays.ramp(size)] = np.searchsorted(vocabulary, hashes)
    order = np.lexsort(terms.T)
    terms, size = terms[order], size[order]
    new = np.ones(len(size), bool)
    new[1:] = (terms[1:] != terms[:-1]).any(axis=1)
    ids = found.column("item_id").take(pa.array(order))
    named = ids.is_valid().to_numpy(zero_copy_only=False)
    held = np.bincount((np.cumsum(new) - 1)[named], minlength=int(new.sum()))
    return Phrases(vocabulary, terms[new], size[new], np.concatenate([[0], np.cumsum(held)]), ids.drop_null().to_numpy())


def build_index(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index table of the documents, stored: postings of all their terms."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"), F.xxhash64(docs[text_col]).alias("text_key"))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.slices(batch, "text", SHARD_BYTES):
                hashes, first = terms_of(part.column(1))
                order = np.argsort(hashes, kind="stable")
                terms, counts = np.unique(hashes[order], return_counts=True)
                n = np.array([part.num_rows])
                yield pa.RecordBatch.from_arrays(
                    [
                        arrays.list_array(part.column(0), n), arrays.list_array(part.column(2), n), arrays.list_array(pa.array(first.astype(np.int32)), n + 1),
                        *(pa.array([x.tobytes()], pa.binary()) for x in (terms.astype("<u8"), counts.astype("<u4"), order.astype("<u4"))),
                    ],
                    names=["doc_ids", "keys", "first", "terms", "counts", "positions"],
                )

    return table(rows.mapInArrow(index, INDEX_SCHEMA).withColumn("shard", F.monotonically_increasing_id()), "postings")


def matches(terms: np.ndarray, counts: np.ndarray, positions: np.ndarray, query: Phrases, first: np.ndarray, slack: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(window number, start word) of each match in one shard."""
    none = np.zeros(0, np.int64)
    if len(terms) == 0 or len(query.lengths) == 0:
        return none, none
    slot = np.minimum(np.searchsorted(terms, query.vocabulary), len(terms) - 1)
    size = np.where(terms[slot] == query.vocabulary, counts[slot], 0)
    begin = (np.cumsum(counts) - counts)[slot]
    held = np.where(query.terms >= 0, size[query.terms], np.iinfo(np.int64).max)
    live = np.flatnonzero((held > 0).all(axis=1))
    if len(live) == 0:
        return none, none
    rarest = np.argsort(held[live], axis=1, kind="stable")  # offsets of each window, rarest term first
    lead = query.terms[live, rarest[:, 0]]
    which = np.repeat(np.arange(len(live)), size[lead])
    start = positions[np.repeat(begin[lead], size[lead]) + arrays.ramp(size[lead])].astype(np.int64) - rarest[which, 0]
    length = query.lengths[live]
    doc = np.searchsorted(first, np.maximum(start, 0), "right") - 1
    fits = (start >= first[doc]) & (start + length[which] <= first[doc + 1])
    which, start, doc = which[fits], start[fits], doc[fits]
    span = np.int64(1) << 33
    postings = np.repeat(np.arange(len(terms)), counts) * span + positions
    for rank in range(1, query.terms.shape[1]):
        used = rank < length[which]
        offset = rarest[which, rank]
        term = query.terms[live[which], offset]
        low = slot[term] * span + np.maximum(start + offset - slack, first[doc])
        high = slot[term] * span + np.minimum(start + offset + slack, first[doc + 1] - 1)
        near = np.searchsorted(postings, low)
        ok = postings[np.minimum(near, len(postings) - 1)]
        keep = ~used | ((near < len(postings)) & (ok >= low) & (ok <= high))
        which, start, doc = which[keep], start[keep], doc[keep]
    return live[which], start


def search(index: DataFrame, query: Phrases, *, slack: int = 0) -> DataFrame:
    """Per indexed document: doc_id, text_key (the xxhash64 of its text), n_words, ``hits`` (its word positions inside
    matches, ascending), ``items`` (ids of the items with matches), and shard
    and place, which tell rows of the same id apart."""
    shared = index.sparkSession.sparkContext.broadcast(query)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                ids, keys, first = batch.column(0)[i].values, batch.column(1)[i].values, batch.column(2)[i].values.to_numpy().astype(np.int64)
                terms, counts, positions = (np.frombuffer(batch.column(c)[i].as_buffer(), kind).astype(wide) for c, kind, wide in ((3, "<u8", arrays.U64), (4, "<u4", np.int64), (5, "<u4", np.int64)))
                which, start = matches(terms, counts, positions, query, first, slack)
                cover = np.zeros(int(first[-1]) + 1, np.int64)
                np.add.at(cover, start, 1)
                np.add.at(cover, start + query.lengths[which], -1)
                hit = np.flatnonzero(np.cumsum(cover)[:-1] > 0)
                own = np.searchsorted(first, hit, "right") - 1
                docs, found = arrays.unique_pairs(np.searchsorted(first, start, "right") - 1, which)
                held = (query.first[1:] - query.first[:-1])[found]
                docs, items = arrays.unique_pairs(np.repeat(docs, held), query.items[np.repeat(query.first[:-1][found], held) + arrays.ramp(held)])
                yield pa.RecordBatch.from_arrays(
                    [ids, keys, pa.array(np.diff(first)), arrays.list_array(pa.array((hit - first[own]).astype(np.int32)), np.bincount(own, minlength=len(ids))), arrays.list_array(pa.array(items, pa.int64()), np.bincount(docs, minlength=len(ids))), pa.array([batch.column(6)[i].as_py()] * len(ids), pa.int64()), pa.array(np.arange(len(ids)))],
                    names=["doc_id", "text_key", "n_words", "hits", "items", "shard", "place"],
                )

    return index.mapInArrow(run, "doc_id long, text_key long, n_words long, hits array<int>, items array<long>, shard long, place long")


def decontaminate(docs: DataFrame, items: DataFrame, *, window: int = 10, slack: int = 0, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", keyed: bool = False) -> DataFrame:
    """Per document: doc_id, with ``keyed`` text_key (the xxhash64 of its text), n_words, ``hits`` and ``items`` for the windows of
    ``window`` consecutive item words (an item with fewer is one window)."""
    asked = items.select(items[item_col].cast("long").alias("item_id"), items[item_text_col].alias("text"))
    pairs = windows(asked, window)
    blocks = max(1, math.ceil(pairs.count() / max(1, QUERY_BYTES // (8 * window + 8))))
    index = build_index(docs, id_col=id_col, text_col=text_col)
    inner = ["shard", "place"] if keyed else ["shard", "place", "text_key"]
    if blocks == 1:
        return search(index, phrases(pairs, window), slack=slack).drop(*inner)
    found = None
    for block in range(blocks):
        part = search(index, phrases(pairs.where(F.pmod(F.xxhash64("terms", "item_id"), F.lit(blocks)) == block), window), slack=slack)
        part = table(part.where(F.size("hits") > 0) if block else part, "found")
        found = part if found is None else found.unionByName(part)
    merge = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    return found.groupBy("shard", "place", "doc_id", "text_key", "n_words").agg(merge("hits"), merge("items")).drop(*inner)
