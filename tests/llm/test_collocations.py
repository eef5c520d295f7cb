"""Phrase collocations and their automata against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from obs_analytics.llm import automata, collocations as co

from .conftest import EDGES

SCHEMA = "doc_id long, text string, lang string"


def brute(rows, longest=3, least=10, cover=50, top=2000):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                f.update((lang, *ws[i : i + k]) for i in range(len(ws) - k + 1))
    chosen = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    dropped = set()
    for (lang, *ws), a in chosen.items():
        for k in range(2, len(ws)):
            for i in range(len(ws) - k + 1):
                part = (lang, *ws[i : i + k])
                if part in chosen and 100 * a >= cover * chosen[part]:
                    dropped.add(part)
    out = {}
    for (lang, *ws), a in chosen.items():
        if (lang, *ws) not in dropped:
            cuts = [(1000000 * a * a // (f[(lang, *ws[:k])] * f[(lang, *ws[k:])]), k) for k in range(1, len(ws))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), f[(lang, *ws[:k])], f[(lang, *ws[k:])]))
    return sorted((lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for lang, found in out.items() for i, (s, a, p, x, y) in enumerate(sorted(found)[:top]))


def found(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(map(tuple, co.collocations(df, cells=1 << 16, **more).collect()))


def prose(seed, n=150):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4)] + ["É", "日本", "A.b", "New"]
    return [(i, "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "  ", "\t", ", ", "\n", ". "]) for _ in range(rng.randrange(1, 60))), rng.choice(["en", "de", None, "w1"])) for i in range(n)]


@pytest.mark.parametrize("longest,least,cover,top", [(3, 10, 50, 2000), (2, 3, 50, 7), (4, 3, 40, 2000)])
def test_against_brute_force(spark, longest, least, cover, top):
    rows = prose(longest)
    expected = brute(rows, longest, least, cover, top)
    assert expected and found(spark, rows, longest=longest, least=least, cover=cover, top=top) == expected


def test_many_ranges_and_flushes(spark, monkeypatch):
    """Tasks that emit often and a sketch without free cells change nothing."""
    rows = prose(7)
    monkeypatch.setattr(co, "HELD", 50)
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    assert sorted(map(tuple, co.collocations(df, least=4, cells=1 << 6, ranges=64).collect())) == brute(rows, least=4)


def test_hot_phrase_and_overlaps(spark):
    rows = [(i, "a a a a a. the the cat " * 40, "en") for i in range(20)] + [(99, "the dog", "en")]
    assert found(spark, rows) == brute(rows)


def test_edges(spark, edges, nothing):
    rows = [(*r, None) for r in EDGES]
    assert found(spark, rows, least=2) == brute(rows, least=2)
    got = co.collocations(edges.selectExpr("*", "cast(null as string) AS lang", "'x' AS phrase", "1 AS a", "2 AS salt", "3 AS names"), least=2, cells=1 << 16)
    assert sorted(map(tuple, got.collect())) == brute(rows, least=2)
    assert found(spark, []) == [] and co.collocations(nothing.selectExpr("*", "'en' AS lang")).collect() == []


def test_scores_past_64_bits(spark):
    """10^6 a^2 and l r above 2^63."""
    rows = [(i, "x y " * 2000, "en") for i in range(2000)]
    got = found(spark, rows, longest=2)
    a = 2000 * 2000
    assert 10**6 * a * a > 2**63 and ("en", 1, "x y", a, a, a, 2 * a, 10**6) in got


def random_phrases(rng, n, vocabulary=12, width=4):
    phrases = rng.integers(1, vocabulary, (n, width)).astype(np.uint64)
    phrases[np.arange(width) >= rng.integers(1, width + 1, n)[:, None]] = 0
    return automata.summed(phrases, rng.integers(1, 5, n))


def test_automata():
    """Built, stored, composed with phrases, united: as a dictionary would."""
    rng = np.random.default_rng(1)
    parts = [random_phrases(rng, n) for n in (400, 3, 0, 2000)]
    made = [automata.Transducer.from_bytes(automata.build(*p).to_bytes()) for p in parts]
    total = Counter()
    for (phrases, counts), automaton in zip(parts, made, strict=True):
        assert (automaton.compose(phrases) == counts).all()
        total.update(dict(zip(map(tuple, phrases.tolist()), counts.tolist(), strict=True)))
    phrases, counts = automata.union(made, 4)
    assert dict(zip(map(tuple, phrases.tolist()), counts.tolist(), strict=True)) == total and (automata.ascending(phrases) == np.arange(len(phrases))).all()
    asked = rng.integers(1, 14, (1000, 4)).astype(np.uint64)
    assert (automata.build(phrases, counts).compose(asked) == [total[tuple(p)] for p in asked.tolist()]).all()


def test_runs_build_the_same_automaton():
    """Runs one after another give the automaton of the whole; it is minimal."""
    phrases, counts = random_phrases(np.random.default_rng(2), 3000)
    whole, runs = automata.build(phrases, counts), automata.Builder(4)
    for run in np.split(np.arange(len(phrases)), np.flatnonzero(np.diff(phrases[:, 0])) + 1):
        runs.add(phrases[run], counts[run])
    made = runs.finish()
    assert (made.compose(phrases) == counts).all() and len(made.first) == len(whole.first)
    arcs = [tuple(map(tuple, np.stack([whole.label[a:b].astype(np.int64), whole.weight[a:b], whole.target[a:b]]).tolist())) for a, b in zip(whole.first[:-2], whole.first[1:-1], strict=True)]
    assert len(set(arcs)) == len(arcs)


def test_rare_triples_of_frequent_pairs_are_left_out(spark):
    """Runs of three words that occur too seldom stay in their task, though their pairs occur often."""
    rng = random.Random(5)
    rows = [(" ".join(rng.choice("abcdefghij") for _ in range(300)),) for _ in range(10)]
    texts = spark.createDataFrame(rows, "text string")
    least, cells = 6, 1 << 20
    bits = co.sketch.bitmaps(texts, co._sketch_keys, (least,), cells)[0]
    keys = lambda t: co._linked(co.Pieces(t), co._let_through(co.Pieces(t), bits)[1])[2]
    linked_bits = co.sketch.bitmaps(texts, keys, (least,), cells)[0]
    found = co.Pieces(co.pa.array([r[0] for r in rows]))
    phrases = co.phrases_of(found, np.ones(len(rows), np.uint64), 3, bits, linked_bits)[1]
    told = Counter(len(p.split()) for p in Counter(" ".join(r[0].split()[i : i + n]) for r in rows for n in (1, 2, 3) for i in range(300 - n + 1)))
    often = Counter(w for r in rows for w in zip(r[0].split(), r[0].split()[1:], r[0].split()[2:]))
    assert told[3] > 800 and ((phrases != 0).sum(1) == 4).sum() == sum(n >= least for n in often.values())


def test_written_small():
    """Labels that follow from names are not written, arcs by narrow gaps; what is read is the same."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(3000)]
    names = co._packed(["en", ""], words)
    labels, strings = co._named(co.pa.scalar(names, co.pa.binary()))
    assert sorted(strings.to_pylist()) == sorted(["en", "", *words]) and (np.diff(labels.astype(object)) > 0).all()
    assert (co.Pieces(co.pa.array(words)).hashes == labels[[strings.to_pylist().index(w) for w in words]]).all()
    phrases, counts = np.stack([np.full(20000, labels[0]), rng.choice(labels, 20000), np.where(rng.random(20000) < 0.5, rng.choice(labels, 20000), 0)], 1), np.ones(20000, np.int64)
    phrases, counts = automata.summed(phrases.astype(np.uint64), counts)
    made = automata.build(phrases, counts)
    data = made.to_bytes(labels)
    assert len(data) + len(names) < len(made.to_bytes())
    read = automata.Transducer.from_bytes(data, labels)
    assert (read.compose(phrases) == counts).all() and (read.label == made.label).all()


def test_empty_language(spark):
    """An empty language is one of its own beside others."""
    rows = [(i, "a b a b", lang) for i in range(6) for lang in ("", "en", None)]
    assert found(spark, rows, least=3) == brute(rows, least=3)
