"""Hard-negative mining against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from obs_analytics.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every, positives=5, negatives=10):
    """Rows (anchor, positive, rank, negative, scores) by full scans."""
    kept = []
    for i, v, label in rows:
        if v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((hn.LAST if i is None else i, [math.floor(256.0 * float(np.float32(x))) for x in v], label))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, v, label in dict.fromkeys((i, tuple(v), label) for i, v, label in kept if i != hn.LAST and i % every == 0):
        scored = sorted(((-dot(v, w), j, other) for j, w, other in kept if j != i))
        for p, positive, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [s for s in scored if s[2] != label and -30 * p <= -100 * s[0] <= -90 * p]
            out += [(i, positive, r + 1, n, -p, -s) for r, (s, n, _) in enumerate(fit[:negatives])]
    return sorted((tuple(None if x == hn.LAST else x for x in row) for row in out), key=str)


def found(spark, rows, every, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(map(tuple, hn.hard_negatives(df, anchor=F.col("vec_id") % every == 0, **more).collect()), key=str)


def clustered(seed, n, size=8):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, size))
    return [(i, (centres[i % 6] + rng.standard_normal(size) * 0.05).astype(np.float32).tolist(), int(rng.integers(3))) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = clustered(seed, 300)
    assert found(spark, rows, 25) == brute(rows, 25)


def test_several_groups_of_anchors(spark):
    rows = clustered(3, 200)
    assert found(spark, rows, 10, group_bytes=400) == brute(rows, 10)


def test_edges(spark):
    """Ties, repeated rows, null labels, vectors, components and ids, non-finite
    components, vectors of other lengths, zero and negative scores."""
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [1.0, 0.5], 1), (3, [0.7, 0.2], 2), (4, [0.7, 0.2], 2), (4, [0.7, 0.2], 2), (None, [0.7, 0.2], 2),
            (5, None, 1), (6, [1.0, None], 2), (7, [1.0, inf], 2), (8, [1.0, nan], 2), (9, [1.0, 1.0], None), (10, [0.9], 1), (11, [0.5], 2), (12, [], 2),
            (20, [0.0, 0.0], 1), (30, [-1.0, -0.5], 2), (40, [0.25, 0.125, 9.0], 1), (40, [0.25, 0.125, 9.0], 1), (50, [], 3), (None, [1.0, 0.5], 1)]
    assert found(spark, rows, 10, negatives=3) == brute(rows, 10, negatives=3)


def test_nothing_to_mine(spark):
    assert found(spark, [], 10) == [] and found(spark, [(1, [1.0], 1), (2, [1.0], 2)], 10) == []
    assert found(spark, [(10, [1.0], 1), (20, [1.0], 2)], 10) == []  # no positives


def test_clashing_columns(spark):
    rows = clustered(4, 60)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS place", "'x' AS bucket", "2 AS anchor", "3 AS rank", "4 AS score", "5 AS vector")
    got = hn.hard_negatives(df, anchor=F.col("vec_id") % 20 == 0).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 20)


def test_bounds_spare_rows():
    """In tight clusters far rows are never scored, and nothing is lost."""
    rng = np.random.default_rng(5)
    centres = 100 * rng.standard_normal((4, 16))
    points = np.floor(256 * np.concatenate([c + rng.standard_normal((500, 16)) * 0.01 for c in centres]))
    ids, labels, some = np.arange(2000), np.arange(2000) % 2, np.arange(0, 2000, 40)
    parent, edge = hn.spanning_tree(points[some])
    group = hn.Anchors(ids[some], labels[some], points[some], parent, edge, [slice(0, len(some))])
    scores = hn.products(points[some], points)
    wanted = (labels[some][:, None] != labels) & (ids[some][:, None] != ids)
    tenth = -np.sort(-np.where(wanted, scores, -hn.LAST), axis=1)[:, 9]
    search = hn.Search(group, tenth[:, None], np.full((50, 1), hn.LAST), 10, False)
    for at in range(0, 2000, 100):
        search.tile(ids[at : at + 100], labels[at : at + 100], points[at : at + 100])
    assert (np.bincount(search.best()[0], minlength=50) == 10).all()
    assert search.rescored < search.seen / 2


def test_spanning_tree_is_least():
    points = np.random.default_rng(6).standard_normal((12, 3))
    parent, edge = hn.spanning_tree(points)
    away = np.sqrt(((points[:, None] - points) ** 2).sum(-1))
    joined, total = {0}, 0.0
    while len(joined) < 12:
        d, j = min((away[i, j], j) for i in joined for j in set(range(12)) - joined)
        joined.add(j)
        total += d
    assert edge.sum() == pytest.approx(total) and np.allclose(edge[1:], away[np.arange(1, 12), parent[1:]])
    assert sorted(np.concatenate(hn.levels_of(parent))) == list(range(12))


def test_large_components_are_exact():
    a = np.array([[2.0**40, 3.0, 1.0]])
    a[0, 0] = 2.0**30
    assert hn.products(a, a)[0, 0] == 2**60 + 10
