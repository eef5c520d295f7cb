"""SimHash near-dedup against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from obs_analytics.llm import simhash as sh
from obs_analytics.llm.queries import QUERIES

from .conftest import EDGES


def brute_fingerprint(text, width=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    runs = [ws[i : i + width] for i in range(len(ws) - width + 1)] or ([ws] if ws else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """For each fingerprint the index of the first that links reach."""
    up = list(range(len(prints)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= sh.ERRORS:
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return [top(i) for i in range(len(prints))]


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    prints = [brute_fingerprint(t) for _, t in rows]
    return sorted(((d, f"{f:016x}", rows[c][0]) for (d, _), f, c in zip(rows, prints, brute_components(prints), strict=True)), key=str)


def near_texts(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 60, 400]))] for _ in range(8)]
    out = []
    for i in range(n):
        text = list(rng.choice(bases))
        for _ in range(rng.randrange(3)):
            text[rng.randrange(len(text))] = rng.choice(vocabulary)
        out.append((100 + i, rng.choice([" ", "  ", "\n"]).join(text).replace("w1", "W1")))
    return out


def test_fingerprints():
    texts = [t for _, t in EDGES + near_texts(1)] + ["É a B\x0bc", "x y z w", "a a a a a a"]
    assert [int(f) for f in sh.fingerprints(pa.array(texts))] == [brute_fingerprint(t) for t in texts]


def test_golay_code_is_perfect():
    words = np.arange(1 << 23, dtype=np.int32)
    index = sh.codeword_index(words)
    assert (np.bincount(index, minlength=1 << 12) == 1 << 11).all()  # each codeword has all words within three errors
    codewords = words[sh._golay()[0] == 0]
    assert np.bitwise_count(codewords[1:]).min() == 7


def test_linked_fingerprints_share_a_key():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 63, 5000).astype(np.uint64) << np.uint64(1)
    b = a.copy()
    for _ in range(4):
        b ^= np.uint64(1) << rng.integers(0, 64, len(a)).astype(np.uint64)
    (ka, ia), (kb, ib) = sh.segment_keys(a), sh.segment_keys(b)
    both = set(zip(ka.tolist(), ia.tolist(), strict=True)) & set(zip(kb.tolist(), ib.tolist(), strict=True))
    assert len({i for _, i in both}) == 5000


def clouds(seed, n):
    """Fingerprints around few centres, so that groups are large and chains long."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(3)]
    out = set()
    while len(out) < n:
        x = rng.choice(centres)
        for _ in range(rng.randrange(8)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("n", [5, 30, 300])
def test_links_of_a_group(n):
    prints = clouds(n, n)
    a, b = sh.group_links(np.zeros(n, np.int64), np.array(prints, np.uint64))
    up = {p: p for p in prints}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        assert (x ^ y).bit_count() <= sh.ERRORS
        p, q = sorted((top(x), top(y)))
        up[q] = p
    assert [top(p) for p in prints] == [prints[c] for c in brute_components(prints)]


def test_links_across_blocks(spark):
    """Groups far above the block size are compared block by block."""
    prints = clouds(9, 400)
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fingerprint long")
    for most in (8, 4096):
        links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in sh.near_links(frame, most).collect()]
        up = {p: p for p in prints}

        def top(x, up=up):
            while up[x] != x:
                x = up[x]
            return x

        for x, y in links:
            assert (x ^ y).bit_count() <= sh.ERRORS
            p, q = sorted((top(x), top(y)))
            up[q] = p
        assert [top(p) for p in prints] == [prints[c] for c in brute_components(prints)]


def test_documents(spark):
    rows = near_texts(3) + EDGES
    got = sh.simhash_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_clashing_columns_and_empty(edges, nothing):
    got = sh.simhash_dedup(edges.withColumnRenamed("n", "fingerprint").withColumnRenamed("node", "key"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(EDGES)
    assert sh.simhash_dedup(nothing).collect() == []


def test_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op12_simhash"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got), key=str) == brute([tuple(r) for r in rows])
