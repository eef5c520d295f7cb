"""Substring dedup, fingerprints, line dedup and the Jaccard join against brute force."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from obs_analytics.llm import fingerprints, graph, jaccard_join, line_dedup, queries, substring_dedup

from .conftest import EDGES

SF_DIR = "/root/testdata/sf0.001"
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return SPACE_WORD.findall(text or "")


def passages(seed, n=40):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    shared = [[rng.choice(vocabulary) for _ in range(rng.randrange(5, 30))] for _ in range(4)]
    out = []
    for i in range(n):
        text = []
        for _ in range(rng.randrange(1, 5)):
            text += rng.choice(shared) if rng.random() < 0.5 else [rng.choice(vocabulary) for _ in range(rng.randrange(1, 15))]
        out.append((1000 + i, rng.choice([" ", "  ", "\n"]).join(text)))
    return out


def text_key(text):
    """Spark's xxhash64 of a string; of null its seed."""
    return 42 if text is None else (lambda h: h - (1 << 64) if h >> 63 else h)(xxhash.xxh64_intdigest(text.encode(), 42))


def brute_substrings(rows, width):
    first, out = {}, []
    ordered = [(d, words(t)) for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, text_key(r[1])))]
    for row, (_, ws) in enumerate(ordered):
        for i in range(len(ws) - width + 1):
            first.setdefault(tuple(ws[i : i + width]), (row, i))
    for row, (d, ws) in enumerate(ordered):
        gone = set()
        for i in range(len(ws) - width + 1):
            if first[tuple(ws[i : i + width])] != (row, i):
                gone.update(range(i, i + width))
        out.append((d, len(ws), len(gone), " ".join(w for i, w in enumerate(ws) if i not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("width", [6, 20])
def test_substrings(spark, width):
    rows = passages(width) + EDGES
    got = substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"), width=width, cells=1 << 16)
    assert sorted(map(tuple, got.collect()), key=str) == brute_substrings(rows, width)


def test_substrings_saturated_sketch_loses_nothing(spark):
    rows = passages(3)
    got = substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"), width=6, cells=1 << 4)
    assert sorted(map(tuple, got.collect()), key=str) == brute_substrings(rows, 6)


def shared_passages(ids):
    """Texts of which each passage is held by two, and some rows twice."""
    rng = random.Random(8)
    out = []
    for i in range(300):
        passage = [f"p{i}x{j}" for j in range(8)]
        for copy in range(2):
            out.append((ids(len(out)), " ".join([f"own{i}c{copy}"] * rng.randrange(4) + passage)))
    return out + out[:40]


@pytest.mark.parametrize("partitions", [1, 5, 8])
@pytest.mark.parametrize("ids", [lambda i: None, lambda i: 7, lambda i: i // 5 if i % 3 else None], ids=["no ids", "one id", "some"])
def test_substrings_of_rows_without_ids_of_their_own(spark, ids, partitions):
    """Missing and repeated ids: the same rows on every layout, as brute force orders them."""
    rows = shared_passages(ids)
    got = substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions), width=6, cells=1 << 16)
    assert sorted(map(tuple, got.collect()), key=str) == brute_substrings(rows, 6)


def test_substrings_of_small_batches(spark):
    """A row's starts and equal rows that are spread over Arrow batches."""
    rows = shared_passages(lambda i: i // 4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"), width=6, cells=1 << 16).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, got), key=str) == brute_substrings(rows, 6)


def test_substrings_clashing_columns_and_empty(edges, nothing):
    assert substring_dedup.substring_dedup(edges, cells=1 << 16).count() == len(EDGES)
    assert substring_dedup.substring_dedup(nothing, cells=1 << 16).count() == 0


def shingles(text, width=5):
    ws = words(text)
    return {tuple(ws[i : i + width]) for i in range(len(ws) - width + 1)} or ({tuple(ws)} if ws else set())


def test_fingerprint_estimates(spark):
    rng = random.Random(5)
    base = [f"v{rng.randrange(300)}" for _ in range(900)]
    pairs = [(i, " ".join(base[:n]), " ".join(base[i * 20 : n + i * 10])) for i, n in enumerate([3, 40, 100, 400, 900])]
    pairs += [(10, "", ""), (11, None, "x"), (12, "x", "x"), (13, "a b c d e f", "a b c d e g")]
    df = spark.createDataFrame(pairs, "i long, a string, b string")
    fa, fb = fingerprints.fingerprint(F.col("a")), fingerprints.fingerprint(F.col("b"))
    made = df.select("i", "a", "b", fa.alias("x"), fb.alias("y"))
    got = made.select("a", "b", "x", "y", fingerprints.resemblance(F.col("x"), F.col("y")).alias("like"),
                      fingerprints.containment(F.col("x"), F.col("y")).alias("inside"), fingerprints.distinct_shingles(F.col("x")).alias("n")).collect()
    for r in got:
        a, b = shingles(r.a), shingles(r.b)
        exact = max(len(a), len(b)) <= fingerprints.K // 2
        near = 1e-9 if exact else 0.15
        assert r.like == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0, abs=near)
        assert r.inside == pytest.approx(len(a & b) / len(a) if a else 1.0, abs=near)
        assert r.n == pytest.approx(len(a), rel=near if exact else 0.3)
        assert (r.x == r.y) == (a == b) or not exact


def test_fingerprints_merge(spark):
    text = " ".join(f"q{i * i % 701}" for i in range(1500))
    ws = text.split()
    parts = [(1, " ".join(ws[i : i + 104])) for i in range(0, 1500, 100)] + [(2, None), (None, "p q r")]
    df = spark.createDataFrame(parts, "g long, text string").select("g", fingerprints.fingerprint(F.col("text")).alias("f"))
    got = {r.g: r.f for r in fingerprints.merge_parts(df, "g", "f").collect()}
    whole = spark.createDataFrame([(text,)], "text string").select(fingerprints.fingerprint(F.col("text")).alias("f")).first().f
    assert got[1] == whole and got[2] == []


def test_next_documents(spark, edges, nothing):
    got = fingerprints.with_next(edges).collect()
    assert len(got) == len(EDGES)
    by_id = {r.doc_id: r for r in got}
    text = dict(EDGES)
    assert by_id[1].next_text == "" and by_id[2].next_text == text[3] and by_id[9].next_text == "no id here"
    assert by_id[None].next_text is None and by_id[None].next_fingerprint == []  # the first document's text is null
    assert by_id[6].fingerprint == by_id[7].fingerprint == by_id[6].next_fingerprint
    assert fingerprints.with_next(nothing).count() == 0


def test_next_documents_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "BUCKET_ROWS", 7)
    rows = [(3 * i, f"text {i}") for i in range(100)]
    got = {r.doc_id: r.next_text for r in fingerprints.with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {3 * i: f"text {(i + 1) % 100}" for i in range(100)}


def test_fingerprint_query(spark):
    """op2's whole result, from texts edited in Python and sketches compared by sets."""
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    texts = [r.text or "" for r in rows]
    edited = []
    for i, text in enumerate(texts):
        cut = len(text) // 4
        edited.append(text[: len(text) - cut] + texts[(i + 1) % len(texts)][:cut])
    pairs = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(texts, edited, strict=True))], "i long, a string, b string")
    own, other = {}, {}
    for r in pairs.select("i", fingerprints.fingerprint(F.col("a")).alias("x"), fingerprints.fingerprint(F.col("b")).alias("y")).collect():
        own[r.i], other[r.i] = r.x, r.y

    def like(a, b):
        union = sorted({*a, *b})[: fingerprints.K]
        return len({*union} & {*a} & {*b}) / len(union) if union else 1.0

    def text_of(f):
        return "".join(f"{x & (1 << 64) - 1:016X}" for x in f)

    got = {r.doc_id: r for r in queries.op2_fingerprints(spark, SF_DIR).collect()}
    assert len(got) == len(rows)
    for i, row in enumerate(rows):
        r = got[row.doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(texts[i]), hashlib.sha256(edited[i].encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (text_of(own[i]), text_of(other[i]))
        assert r.near_edited == pytest.approx(like(own[i], other[i])) and r.near_next == pytest.approx(like(own[i], own[(i + 1) % len(rows)]))


def one_edit(a, b):
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def brute_lines(rows, least):
    lines = []
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        lines += [((d is None, d or 0, no), line) for no, line in enumerate((t or "").split("\n"))]
    keep = {}
    for at, line in lines:
        if len(line) >= least:
            keep[at] = not any(p < at and len(o) >= least and one_edit(line, o) for p, o in lines)
        else:
            keep[at] = not re.search(r"[^ \t\n\x0B\f\r]", line) or not any(p < at and line == o for p, o in lines)
    out = []
    for d, t in rows:
        own = (t or "").split("\n")
        left = [x for no, x in enumerate(own) if keep[(d is None, d or 0, no)]]
        out.append((d, len(own), len(own) - len(left), "\n".join(left)))
    return sorted(out, key=str)


def test_lines(spark):
    rng = random.Random(9)
    base = ["".join(rng.choice("abé d") for _ in range(rng.choice([19, 20, 21, 35]))) for _ in range(12)]
    rows = []
    for i in range(60):
        own = []
        for _ in range(rng.randrange(0, 4)):
            line = rng.choice(base)
            for _ in range(rng.choice([0, 1, 1, 2])):
                at, kind = rng.randrange(len(line)), rng.randrange(3)
                line = line[:at] + ("" if kind == 0 else rng.choice("abé") + (line[at] if kind == 2 else "")) + line[at + 1 :]
            own.append(line)
        rows.append((100 + i, "\n".join(own)))
    rows += EDGES
    got = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute_lines(rows, line_dedup.LEAST)


def test_short_lines_repeat(spark):
    """Exact repeats of short lines go, near copies of them and blank lines stay."""
    long = "a line of more than twenty characters"
    rows = [(1, "Share\nRead more\n\n好\n  "), (2, f"Read more\nRead mode\n\n{long}\nx\n  "), (3, f"x\n{long}!\n好\nRead more\n{long}"), (None, "Share\nalone")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {1: "Share\nRead more\n\n好\n  ", 2: f"Read mode\n\n{long}\nx\n  ", 3: "", None: "alone"}
    got = line_dedup.line_dedup(df).collect()
    assert {r.doc_id: r.kept for r in got} == want
    assert {r.doc_id: (r.n_lines, r.n_removed) for r in got} == {1: (5, 0), 2: (6, 1), 3: (5, 5), None: (2, 1)}
    five = {r.doc_id: r.kept for r in line_dedup.line_dedup(df, shortest=6).collect()}
    assert five == {**want, 3: "x\n好", None: "Share\nalone"}


def test_lines_carry_columns_and_empty(edges, nothing):
    got = line_dedup.line_dedup(edges, carry=["place", "kept"])
    assert got.columns == ["doc_id", "n_lines", "n_removed", "kept", "place", "kept"] and got.count() == len(EDGES)
    assert line_dedup.line_dedup(nothing).count() == 0


def brute_components(rows, width, percent):
    def grams(text):
        ws = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
        return {tuple(ws[i : i + width]) for i in range(len(ws) - width + 1)} or ({tuple(ws)} if ws else set())

    sets = [(d, grams(t)) for d, t in rows]
    key = lambda d: (1, 0) if d is None else (0, d)
    up = {key(d): key(d) for d, _ in rows}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (d, a) in enumerate(sets):
        for e, b in sets[:i]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = top(key(d)), top(key(e))
                up[max(p, q)] = min(p, q)
    back = lambda k: None if k[0] else k[1]
    return sorted(((d, len(a), back(top(key(d)))) for d, a in sets), key=str)


@pytest.mark.parametrize(("width", "percent", "most"), [(3, 90, 16), (5, 80, 256)])
def test_jaccard(spark, monkeypatch, width, percent, most):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for i in range(110):
        ws = base[: rng.choice([50, 55, 60])]
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            ws[rng.randrange(len(ws))] = rng.choice(vocabulary)
        rows.append((100 + i, " ".join(ws)))
    rows += [*EDGES, (50, "a b"), (51, "A B"), (52, "no id here"), (53, "other text here now"), (103, "other text here now")]
    blocks = jaccard_join.block_links
    monkeypatch.setattr(jaccard_join, "block_links", lambda *a: blocks(*a, most=most))
    got = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), width=width, percent=percent, cells=1 << 18)
    assert sorted(map(tuple, got.collect()), key=str) == brute_components(rows, width, percent)


def test_jaccard_keys_listed_grow_with_the_rows(spark, monkeypatch):
    """Unlike texts list their own keys and no more, however many rows there are."""
    rng, found, rarest = random.Random(2), [], jaccard_join.rarest_keys
    monkeypatch.setattr(jaccard_join, "rarest_keys", lambda listed: (found.append(listed.count()), rarest(listed))[1])
    for n in (40, 200):
        rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(100))) for i in range(n)]
        got = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), cells=1 << 12).collect()
        assert sorted((r.doc_id, r.component_id) for r in got) == [(i, i) for i in range(n)]
    assert found[0] and found[1] < 5.5 * found[0]


def test_jaccard_rows_without_an_id_bridge_nothing(spark):
    """Copies without an id join their own groups and tie none together; a
    text without an id that links to two documents still joins them."""
    a, b, c, e = (" ".join(f"{x}{i}" for i in range(60)) for x in "abce")
    near = lambda text, *at: " ".join(f"z{i}" if i in at else w for i, w in enumerate(text.split()))
    rows = [(5, a), (9, b), (None, a), (None, b), (None, near(b, 0)), (None, c), (None, near(c, 0)), (-7, e), (None, e), (None, ""), (None, None)]
    rows += [(20, "k " + a + " " + c), (21, near("k " + a + " " + c, 0, 1, 2)), (None, near("k " + a + " " + c, 0))]
    got = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), cells=1 << 18).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == sorted(
        [(5, 5), (9, 9), (-7, -7), (20, 20), (21, 20), *((None, x) for x in (5, 9, 9, None, None, -7, None, None, 20))], key=str)


def test_jaccard_clashing_columns_and_empty(edges, nothing):
    assert jaccard_join.jaccard_join(edges, cells=1 << 18).count() == len(EDGES)
    assert jaccard_join.jaccard_join(nothing, cells=1 << 18).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (None, 3), (200, 100)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100, 200: 100}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
