"""Hard-negative mining (operator 13): near rows of another label per anchor and positive.

Components are quantised to floor(scale * x); a score is the inner product of
two quantised vectors. An anchor's positives are its highest-scoring other rows
of its label; the negatives of a positive are the highest-scoring rows of other
labels whose score lies between ``low`` and ``high`` per cent of the positive's.

1. Anchors are sorted by the signs of random projections and cut into groups of
   a bounded number of bytes, so that neighbours share a group; a group is
   broadcast, searched against all rows, and forgotten. Inside a group, blocks
   of anchors form a spanning tree of least distances.
2. A task scores the root of each tree against a tile of rows. The score at a
   child differs from the score at its parent by at most the edge's distance
   times the row's norm, so a row's interval at a child follows from the parent's.
   Only rows whose interval meets the child's window are scored exactly; a child
   that needs many of a tile's rows is scored for the whole tile in one product.
3. A window starts at the lowest score that can still matter: the rows are taken
   in rounds of a 64th, an 8th and all of them, the bounds of a round being the
   last places of the round before. A bound never exceeds the true last place,
   so no row is lost, and what tasks return stays near eight times the result.

Defined results: rows with a null label or vector, or a null or non-finite
component, take no part; an empty vector scores 0 with everything, and a shorter
vector counts as padded with zeros; "other" rows are those of another id;
rows that repeat count each, anchors that repeat once; rows without an id come
last among ties and are never anchors; without anchors the result is empty;
further columns are left out. Sums are exact while they fit 63 bits.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obs_analytics.llm.checkpoints import cut, shared_folder, table

LAST = (1 << 63) - 1  # place of rows without an id
BLOCK, TILE = 256, 2048
GROUP_BYTES = 16 << 20  # quantised anchors that are broadcast at a time
ROUNDS, BUCKETS = ((0, 1), (1, 8), (8, 64)), 64
SIGNS = 16
HELD = 1 << 20  # rows that a task gathers before it keeps the best
DENSE = 0.2  # share of a tile's rows to rescore from which the whole tile is scored in one product


def quantised(vectors: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """(indices of the rows that take part, their quantised vectors as rows of
    doubles padded with zeros)."""
    size = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null component is NaN
    row, ends = np.repeat(np.arange(len(size)), size), np.cumsum(size)
    bad = np.bincount(row, ~np.isfinite(flat), len(size)) > 0
    bad |= vectors.is_null().to_numpy(zero_copy_only=False)
    keep = np.flatnonzero(~bad)
    out = np.zeros((len(size), int(size.max(initial=0))))
    out[row, np.arange(len(flat)) - np.repeat(ends - size, size)] = np.floor(scale * np.where(np.isfinite(flat), flat, 0))
    return keep, out[keep]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of a with all rows of b as 64-bit integers."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if width * np.abs(a).max(initial=0) * np.abs(b).max(initial=0) < 1 << 53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parent, edge length) of each point in a spanning tree of least total
    distance; point 0 is the root and its own parent."""
    parent, nearest = np.zeros(len(points), np.int64), np.full(len(points), np.inf)
    outside, now = np.ones(len(points), bool), 0
    edge = np.zeros(len(points))
    for _ in range(len(points) - 1):
        outside[now] = False
        away = np.sqrt(((points - points[now]) ** 2).sum(1))
        closer = outside & (away < nearest)
        nearest[closer], parent[closer] = away[closer], now
        now = int(np.argmin(np.where(outside, nearest, np.inf)))
        edge[now] = nearest[now]
    return parent, edge


def levels_of(parent: np.ndarray) -> list[np.ndarray]:
    """The points of a tree by their distance from the root in edges."""
    depth, at = np.zeros(len(parent), np.int64), parent.copy()
    depth[at != np.arange(len(parent))] = 1
    while (at != at[at]).any() or (parent[at] != at).any():
        moving = parent[at] != at
        depth[moving] += 1
        at = np.where(moving, parent[at], at)
    return [np.flatnonzero(depth == d) for d in range(int(depth.max(initial=0)) + 1)]


@dataclass
class Anchors:
    """One group of anchors: blocks of rows, each with its tree."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    parent: np.ndarray  # within the block
    edge: np.ndarray
    blocks: list[slice]


class Search:
    """The best rows of each window of each anchor, tile by tile. Windows are
    closed score intervals, ``low`` and ``high`` (anchors x windows)."""

    def __init__(self, group: Anchors, low: np.ndarray, high: np.ndarray, most: int, same_label: bool) -> None:
        self.group, self.low, self.high, self.most, self.same = group, low.copy(), high, most, same_label
        self.levels = [levels_of(group.parent[b]) for b in group.blocks]
        self.held: list[np.ndarray] = []
        self.n_held = self.rescored = self.seen = 0

    def tile(self, places: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        g = self.group
        norm = np.sqrt((vectors**2).sum(1))
        for block, levels in zip(g.blocks, self.levels, strict=True):
            n = block.stop - block.start
            least, largest = np.empty((n, len(places))), np.empty((n, len(places)))
            for nodes in levels:
                at = nodes + block.start
                fits = (g.labels[at][:, None] == labels) if self.same else (g.labels[at][:, None] != labels)
                fits &= g.ids[at][:, None] != places
                root = nodes[0] == 0
                if root:
                    least[0], largest[0] = -np.inf, np.inf
                else:
                    up, reach = g.parent[at], g.edge[at][:, None] * norm * (1 + 1e-9) + 1
                    least[nodes], largest[nodes] = least[up] - reach, largest[up] + reach
                low, high = self.low[at], self.high[at]
                live = (low <= high).any(1)
                first, last = np.where(low <= high, low, LAST).min(1), np.where(low <= high, high, -LAST).max(1)
                wanted = fits & live[:, None] & (largest[nodes] >= first[:, None].astype(float) - 1) & (least[nodes] <= last[:, None].astype(float) + 1)
                self.seen += wanted.size
                share = wanted.mean(1)
                most = share > (-1 if root else DENSE)
                scores = products(g.vectors[at[most]], vectors)
                self.rescored += scores.size
                least[nodes[most]] = largest[nodes[most]] = scores
                row = np.flatnonzero(most)
                i, c = np.nonzero(wanted[most] & (scores >= first[most][:, None]) & (scores <= last[most][:, None]))
                rows, columns, found = [row[i]], [c], [scores[i, c]]
                for k in np.flatnonzero(~most & (share > 0)):
                    c = np.flatnonzero(wanted[k])
                    scores = products(g.vectors[at[k]][None], vectors[c])[0]
                    self.rescored += len(c)
                    least[nodes[k], c] = largest[nodes[k], c] = scores
                    rows, columns, found = [*rows, np.full(len(c), k)], [*columns, c], [*found, scores]
                i, c, found = np.concatenate(rows), np.concatenate(columns), np.concatenate(found)
                for j in range(self.low.shape[1]):
                    ok = (found >= low[i, j]) & (found <= high[i, j])
                    if ok.any():
                        self._hold(at[i[ok]], j, found[ok], places[c[ok]])

    def _hold(self, anchor: np.ndarray, window: int, score: np.ndarray, place: np.ndarray) -> None:
        self.held.append(np.stack([anchor, np.full(len(anchor), window), score, place]))
        self.n_held += len(anchor)
        if self.n_held > HELD:
            self.best()

    def best(self) -> np.ndarray:
        """Rows (anchor, window, score, place) that may be among the first of
        their window; windows that are full start at their last place from now on."""
        rows = np.concatenate(self.held, 1) if self.held else np.zeros((4, 0), np.int64)
        rows = rows[:, np.lexsort((rows[3], -rows[2], rows[1], rows[0]))]
        new = np.ones(rows.shape[1], bool)
        new[1:] = (np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0)
        start = np.flatnonzero(new)
        rank = np.arange(rows.shape[1]) - np.repeat(start, np.diff(np.append(start, rows.shape[1])))
        rows, rank = rows[:, rank < self.most], rank[rank < self.most]
        full = rank == self.most - 1
        self.low[rows[0, full], rows[1, full]] = np.maximum(self.low[rows[0, full], rows[1, full]], rows[2, full])
        self.held, self.n_held = [rows], rows.shape[1]
        return rows


def _blocks(anchors: DataFrame) -> DataFrame:
    """Anchors as rows of up to BLOCK of one group, with the tree of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def made() -> pa.RecordBatch:
            ids, labels, vectors = zip(*held, strict=True)
            width = max(map(len, vectors)) // 8
            points = np.zeros((len(vectors), width))
            for i, v in enumerate(vectors):
                points[i, : len(v) // 8] = np.frombuffer(v, "<f8")
            parent, edge = spanning_tree(points)
            columns = [x.tobytes() for x in (np.array(ids), np.array(labels), points, parent, edge)]
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int32()), pa.array([len(ids)], pa.int32()), *(pa.array([x], pa.binary()) for x in columns)],
                names=["group", "n", "ids", "labels", "points", "parent", "edge"],
            )

        for batch in batches:
            for group, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (group != now or len(held) == BLOCK):
                    yield made()
                    held = []
                now = group
                held.append(row)
        if held:
            yield made()

    ordered = anchors.repartition("group").sortWithinPartitions("group", "code", "id").select("group", "id", "label", "vector")
    return ordered.mapInArrow(run, "group int, n int, ids binary, labels binary, points binary, parent binary, edge binary")


def _group(blocks: DataFrame, group: int) -> Anchors:
    rows = blocks.where(F.col("group") == group).collect()  # about GROUP_BYTES
    width = max(len(r.points) // 8 // r.n for r in rows)
    points = [np.frombuffer(r.points).reshape(r.n, -1) for r in rows]
    ends = np.cumsum([r.n for r in rows]).tolist()
    joined = lambda name, kind: np.concatenate([np.frombuffer(r[name], kind) for r in rows])
    return Anchors(
        joined("ids", np.int64), joined("labels", np.int64), np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in points]),
        joined("parent", np.int64), joined("edge", float), [slice(e - r.n, e) for e, r in zip(ends, rows, strict=True)],
    )


def _search(rows: DataFrame, group: Anchors, low: np.ndarray, high: np.ndarray, most: int, scale: float, same_label: bool) -> DataFrame:
    """The first ``most`` rows of each window: (anchor, window, rank, score, place),
    written to the shared folder. ``anchor`` counts within the group."""
    spark, best = rows.sparkSession, None
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "place")
    for start, stop in ROUNDS:
        shared = spark.sparkContext.broadcast((group, low, high))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            search = Search(*shared.value, most, same_label)
            for batch in batches:
                for at in range(0, batch.num_rows, TILE):
                    part = batch.slice(at, TILE)
                    keep, vectors = quantised(part.column(2), scale)
                    search.tile(part.column(0).to_numpy()[keep], part.column(1).to_numpy()[keep], vectors)
            found = search.best()
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[0].astype(np.int32)), pa.array(found[1].astype(np.int32)), pa.array(found[2]), pa.array(found[3])],
                names=["anchor", "window", "score", "place"],
            )

        part = rows.where((F.col("bucket") >= start) & (F.col("bucket") < stop)).select("place", "label", "vector")
        found = part.mapInArrow(run, "anchor int, window int, score long, place long")
        found = found if best is None else found.union(best.select(found.columns))
        best = table(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most), "nearest")
        if stop < BUCKETS:
            full = best.where(F.col("rank") == most).select("anchor", "window", "score").toArrow()  # a number per window
            a, w, s = (full.column(i).to_numpy() for i in range(3))
            low = low.copy()
            low[a, w] = np.maximum(low[a, w], s)
    return best


def hard_negatives(
    vectors: DataFrame, *, anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: float = 256,
    group_bytes: int = GROUP_BYTES, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
) -> DataFrame:
    """Per anchor (rows where ``anchor`` holds) and positive: anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    doc_id = vectors[id_col].cast("long")
    rows = vectors.where(vectors[label_col].isNotNull() & vectors[vector_col].isNotNull()).select(
        F.coalesce(doc_id, F.lit(LAST)).alias("place"), vectors[label_col].cast("long").alias("label"), vectors[vector_col].alias("vector"),
        F.pmod(F.xxhash64(doc_id), F.lit(BUCKETS)).alias("bucket"), (F.coalesce(anchor, F.lit(False)) & doc_id.isNotNull()).alias("anchor"),
    )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, points = quantised(batch.column(2), scale)
            signs = np.random.default_rng(SIGNS).standard_normal((points.shape[1], SIGNS))
            code = ((points @ signs) > 0) @ (1 << np.arange(SIGNS))
            size = pa.array([8 * points.shape[1]] * len(keep), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep)), batch.column(1).take(pa.array(keep)), pa.array(code.astype(np.int32)), size, pa.array([p.tobytes() for p in points], pa.binary())],
                names=["id", "label", "code", "size", "vector"],
            )

    anchors = rows.where("anchor").select("place", "label", "vector").mapInArrow(packed, "id long, label long, code int, size int, vector binary")
    anchors = cut(anchors.dropDuplicates(["id", "label", "vector"]).withColumn("at", F.col("code") * F.lit(1 << 40) + F.pmod(F.xxhash64("id"), F.lit(1 << 40))))
    total = anchors.agg(F.sum("size").alias("bytes")).first().bytes or 0
    groups = max(1, -(-total // group_bytes))
    bounds = anchors.agg(F.percentile_approx("at", [i / groups for i in range(1, groups)] or [0.5], 100 * groups).alias("b")).first().b or []
    bounds = np.unique(np.array(bounds if groups > 1 else [], np.int64))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = np.searchsorted(bounds, batch.column(4).to_numpy()).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(group), *batch.columns[:4]], names=["group", "id", "label", "code", "vector"])

    placed = anchors.select("id", "label", "code", "vector", "at").mapInArrow(numbered, "group int, id long, label long, code int, vector binary")
    blocks = table(_blocks(placed), "anchors")
    out = f"{shared_folder(spark).rstrip('/')}/hard-negatives-{uuid.uuid4().hex}"
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(f"{out}/part=-1")
    for part in range(len(bounds) + 1) if total or not anchors.isEmpty() else ():
        if blocks.where(F.col("group") == part).isEmpty():
            continue
        group = _group(blocks, part)
        n = len(group.ids)
        near = _search(rows, group, np.full((n, 1), -LAST), np.full((n, 1), LAST), positives, scale, True)
        found = near.select("anchor", "rank", "score").toArrow()
        a, r, s = (found.column(i).to_numpy() for i in range(3))
        first, last = np.full((n, positives), LAST), np.full((n, positives), -LAST)
        first[a, r - 1], last[a, r - 1] = -((-low * s) // 100), (high * s) // 100
        far = _search(rows, group, first, last, negatives, scale, False)
        names = spark.createDataFrame(pa.table({"anchor": np.arange(n, dtype=np.int32), "anchor_id": group.ids}))
        chosen = near.select("anchor", (F.col("rank") - 1).alias("window"), F.nullif("place", F.lit(LAST)).alias("positive_id"), F.col("score").alias("positive_score")).join(names, "anchor")
        chosen.join(far, ["anchor", "window"]).select(
            "anchor_id", "positive_id", "rank", F.nullif("place", F.lit(LAST)).alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
        ).write.parquet(f"{out}/part={part}")
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(out)
