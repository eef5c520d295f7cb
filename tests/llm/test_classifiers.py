"""Language ID, quality and toxicity: models against brute force, held-out accuracy, edge rows."""

import itertools
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from obs_analytics.llm import arrays, labelled, language, quality, queries, toxicity

from ..conftest import SF01
from .conftest import EDGES


def toy(seed, n, syllables):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(1, 60))) for _ in range(n)]


def test_kernel_is_the_blended_spectrum():
    texts = ["abcab", "bcd", "", "éa"]
    grams, root = language.presence(pa.array(texts))
    for i, j in itertools.product(range(len(texts)), repeat=2):
        sets = [{t.encode()[k : k + n] for n in (1, 2, 3) for k in range(len(t.encode()) - n + 1)} for t in (texts[i], texts[j])]
        assert grams[i] @ grams[j] / (root[i] * root[j]) == pytest.approx(len(sets[0] & sets[1]) / max(1, len(sets[0]) * len(sets[1])) ** 0.5, abs=1e-6)


def test_language(spark, edges, nothing):
    texts = toy(1, 60, ["an", "the", "ing"]) + toy(2, 60, ["ou", "eau", "é"])
    model = language.fit(texts, ["en"] * 60 + ["fr"] * 60, landmarks=10)
    fresh = toy(3, 40, ["an", "the", "ing"]) + toy(4, 40, ["ou", "eau", "é"])
    margins = model.margins(pa.array(fresh))
    assert [model.languages[i] for i in margins.argmax(axis=1)] == ["en"] * 40 + ["fr"] * 40
    got = {r.doc_id: r for r in language.identify(edges, model).collect()}
    assert {d for d, r in got.items() if r.lang_pred == "und"} == {1, 2, 3} and got[1].score == 0
    assert all(0 <= r.score <= 1 for r in got.values()) and language.identify(edges, model).count() == len(EDGES)
    assert language.identify(nothing, model).count() == 0
    untaught = language.train(nothing, nothing.select("doc_id", F.lit("x").alias("label")))
    assert {r.lang_pred for r in language.identify(edges, untaught).collect()} == {"und"}


def test_language_held_out(spark):
    got = queries.op3_language(spark, SF01).join(spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.99


def test_quadratic_discriminant_densities():
    rng = np.random.default_rng(0)
    x = [rng.normal(size=(200, 3)) @ np.diag([1, 2, 3.0]), rng.normal(size=(100, 3)) + 1]
    model = quality.fit(np.array([200.0, 100.0]), np.stack([a.sum(axis=0) for a in x]), np.stack([a.T @ a for a in x]), pooled=0.3, diagonal=0.1)
    cov = [np.cov(a.T, bias=True) for a in x]
    common = (200 * cov[0] + 100 * cov[1]) / 300
    point, dense = np.array([[0.5, -1, 2]]), []
    for a, c in zip(x, cov, strict=True):
        s = 0.7 * c + 0.3 * common
        s = 0.9 * s + 0.1 * np.diag(np.diag(s)) + 1e-4 * np.eye(3)
        gap = point[0] - a.mean(axis=0)
        dense.append(np.log(len(a)) - 0.5 * np.log(np.linalg.det(s)) - 0.5 * gap @ np.linalg.inv(s) @ gap)
    assert model.scores(point)[0] == pytest.approx(1 / (1 + np.exp(dense[0] - dense[1])))


def test_statistics_by_hand():
    x = dict(zip(quality.NAMES, quality.statistics(pa.array(["Aa bb bb*\nAa.\nAa.", ""])).T, strict=True))
    assert x["log_words"] == pytest.approx(np.log1p([5, 0]))
    assert x["repeated_neighbours"][0] == pytest.approx(np.log(1 / 5 + 0.005))  # Aa. Aa.
    assert x["distinct_words"][0] == pytest.approx(np.log(4 / 5 + 0.02)) and x["distinct_lines"][0] == pytest.approx(np.log(2 / 3 + 0.05))
    assert x["ended_lines"].tolist() == pytest.approx([2 / 3, 0]) and x["marked_words"][0] == pytest.approx(np.log(1 / 5 + 0.02))


def test_quality_edges(spark, edges, nothing):
    vectors = quality.measured(edges)
    labels = spark.createDataFrame([(4, 1), (5, 1), (6, 0), (7, 0), (8, 1), (None, 1), (9, None), (9, 0)], "doc_id long, label int")
    for model in (quality.train(vectors, labels), quality.train(vectors, labels.where("label = 1"))):
        got = quality.score(vectors, model).collect()
        assert len(got) == len(EDGES) and all(0 <= r.score <= 1 for r in got)
    assert quality.score(quality.measured(nothing), quality.train(quality.measured(nothing), labels)).count() == 0


def held_out_accuracy(spark, found, column):
    labels = spark.read.parquet(f"{SF01}/labels.parquet").select("doc_id", F.col(column).alias("y"))
    return found.where("held_out").join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col("y")).cast("int"))).first()[0]


def test_quality_held_out(spark):
    assert held_out_accuracy(spark, queries.op8_quality(spark, SF01), "quality") > 0.98


def test_toxicity_held_out(spark):
    assert held_out_accuracy(spark, queries.op10_toxicity(spark, SF01), "toxic") > 0.93


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(1)
    emission, transitions, sentences = rng.normal(size=7), rng.normal(size=(2, 2)), np.array([0, 4, 5, 7])
    p, expected = toxicity.marginals(emission, sentences, transitions)
    want, pairs = np.zeros(7), np.zeros((2, 2))
    for a, b in zip(sentences[:-1], sentences[1:], strict=True):
        paths = list(itertools.product((0, 1), repeat=b - a))
        weight = np.array([np.exp(sum(emission[a + i] * y for i, y in enumerate(path)) + sum(transitions[u, v] for u, v in itertools.pairwise(path))) for path in paths])
        weight /= weight.sum()
        for path, w in zip(paths, weight, strict=True):
            want[a:b] += w * np.array(path)
            for u, v in itertools.pairwise(path):
                pairs[u, v] += w
    assert p == pytest.approx(want) and expected == pytest.approx(pairs)


@pytest.mark.parametrize("lengths", [[7], [3, 1, 11, 4], [1, 1], [9, 2, 3]])
def test_long_sentences_in_pieces(monkeypatch, lengths):
    """Sentences cut into pieces give the marginals and transitions of whole ones."""
    rng = np.random.default_rng(sum(lengths))
    sentences = np.concatenate([[0], np.cumsum(lengths)])
    emission, transitions = 2 * rng.normal(size=sentences[-1]), rng.normal(size=(2, 2))
    p, expected = toxicity.marginals(emission, sentences, transitions)
    for piece in (1, 2, 3):
        monkeypatch.setattr(toxicity, "PIECE", piece)
        q, pairs = toxicity.marginals(emission, sentences, transitions)
        assert q == pytest.approx(p) and pairs == pytest.approx(expected)


def test_one_very_long_sentence():
    """300,000 words without a sentence's end: a step per piece, not per word."""
    n = 300_000
    emission, sentences = np.random.default_rng(2).normal(size=n), np.array([0, 5, n])
    start = time.process_time()
    p, expected = toxicity.marginals(emission, sentences, np.array([[0.3, -1.0], [0.2, 0.9]]))
    assert time.process_time() - start < 3
    assert np.isfinite(p).all() and expected.sum() == pytest.approx(n - 2)


def test_presence_in_blocks(monkeypatch):
    """Long texts are read in blocks; n-grams across a block's end count."""
    texts = pa.array(["", "abcdefghij" * 7, None, "é xyz", "", "q" * 40 + "ab"], pa.large_string())
    whole, _ = language.presence(texts)
    for block in (1, 2, 5, 16):
        monkeypatch.setattr(language.arrays, "SLICE_BYTES", block)
        assert np.array_equal(language.presence(texts)[0], whole)


def test_toxic_spans(spark, edges, nothing):
    clean = toy(5, 150, ["an", "the", "ing"])
    rude = [f"{t} VILE{e} {t}" for t, e in zip(toy(6, 150, ["an", "the", "ing"]), itertools.cycle(["", "ly", "st"]))]
    model = toxicity.fit(clean + rude, np.array([0] * 150 + [1] * 150))
    docs = spark.createDataFrame([(1, "É! the vilest anthe"), (2, "the ing an"), (3, "the vileness an")], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert got[1].score > 0.5 > got[2].score and got[2].spans == []
    assert [(s.start, s.end) for s in got[1].spans] == [(7, 13)] and got[3].score > got[2].score
    rows = toxicity.score(edges, model).collect()
    assert len(rows) == len(EDGES) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(nothing, model).count() == 0
    flat = toxicity.train(nothing, spark.createDataFrame([], "doc_id long, label int"))
    assert {round(r.score, 6) for r in toxicity.score(edges, flat).collect()} == {0.5}


def test_sample_is_bounded_and_stable(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("label"))
    pick = lambda d: sorted(r.doc_id for r in labelled.sample(d, labels.union(labels), 20, [0, 1]).collect())
    assert pick(docs) == pick(docs.repartition(7)) and len(pick(docs)) == 40


def test_word_hashes_ignore_place():
    a, b = (pa.array(x) for x in (["xx word yy", "word"], ["word zz", ""]))
    (ha, fa), (hb, fb) = ((arrays.span_hashes(d, s, e), f) for d, s, e, f in ((d, *arrays.spans(d, o, arrays.SPACE[d] == 0)) for d, o in map(arrays.buffers, (a, b))))
    assert ha[1] == ha[3] == hb[0] and fa.tolist() == [0, 3, 4] and fb.tolist() == [0, 2, 2]
