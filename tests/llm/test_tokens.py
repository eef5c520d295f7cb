"""Byte-level BPE, token files and decontamination against the libraries and brute force."""

import base64
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from obs_analytics.llm import byte_bpe, decontamination, token_files, tokens
from obs_analytics.llm.checkpoints import shared_folder

from .conftest import EDGES

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = ["it's  we'll\n\n  I'd 'tis ''s", "tab\tand  two   spaces ", " nbsp em 　wide\u0085x\x1c y", "😀😀 é ﬁ ǅ ß İ Σς", "<|endoftext|> a<|startoftext|>b",
       "x" * 300, "12345 1,234.5 ½ ٣", "a\r\nb\r c\x0b\x0cd", "퟿ ", " ", "\n", "  \n", "naïve_café-12's"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    alphabet = "abcXYZ 019.,'!?éüß\n\t  😀́-_<|>"
    return EDGES + [(100 + i, t) for i, t in enumerate(ODD)] + [(200 + i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))) for i in range(300)]


def test_byte_bpe_is_the_library(spark, texts):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = byte_bpe.decode(byte_bpe.encode(df, RANKS, PATTERN, offsets=True, keep_text=True), RANKS).collect()
    assert len(got) == len(texts)
    for r in got:
        text = r.text or ""
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == library.encode_ordinary(text), text[:80]
        assert r.n_tokens == len(ids) and bytes(r.decoded) == text.encode()
        if len(text) < 1000:
            pieces, at = [library.decode_single_token_bytes(i) for i in ids], 0
            char_of = [i for i, c in enumerate(text) for _ in c.encode()]
            for piece, start, end in zip(pieces, r.starts, r.ends, strict=True):
                assert (start, end) == (char_of[at], char_of[at + len(piece) - 1] + 1)
                at += len(piece)


def test_byte_bpe_cut_ids_and_clashing_columns(spark, edges, nothing):
    encoded = byte_bpe.encode(edges, RANKS, PATTERN)
    assert encoded.columns == ["doc_id", "n_tokens", "ids"] and encoded.count() == len(EDGES)
    cut = encoded.where("doc_id = 9").select("doc_id", F.expr("substring(ids, 1, length(ids) - 4)").alias("ids")).union(spark.createDataFrame([(0, None)], "doc_id long, ids binary"))
    text = {r.doc_id: r.decoded for r in byte_bpe.decode(cut, RANKS, as_text=True).collect()}
    assert text[0] == "" and dict(EDGES)[9].startswith(text[9].rstrip("�"))
    assert byte_bpe.decode(byte_bpe.encode(nothing, RANKS, PATTERN), RANKS).count() == 0


def test_full_caches_change_nothing(monkeypatch):
    import pyarrow as pa

    sample = pa.array([t for _, t in EDGES if t and len(t) < 100] * 3)
    monkeypatch.setattr(tokens, "RANK_CACHE", 3)
    tokens._ENCODERS.clear()
    small = tokens.rank_encoder(RANKS, PATTERN).encode(sample)
    monkeypatch.undo()
    tokens._ENCODERS.clear()
    whole = tokens.rank_encoder(RANKS, PATTERN).encode(sample)
    assert np.array_equal(small[0], whole[0]) and np.array_equal(small[1], whole[1])


def test_token_files(spark, texts, nothing):
    library = Tokenizer.from_file(WORDS)
    path = f"{shared_folder(spark)}/tokens-{random.random()}"
    token_files.write_tokens(spark.createDataFrame(texts, "doc_id long, text string").repartition(5), path, WORDS)
    got = token_files.read_tokens(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((d for d, _ in texts), key=lambda d: -1 if d is None else d)
    text, start = dict(texts), 0
    for r in got:
        ids = library.encode(text[r.doc_id] or "", add_special_tokens=False).ids + [1]
        assert (r.start, r.n_tokens, r.ids) == (start, len(ids), ids)
        start += len(ids)
    sums = {r.doc_id: r.ids_crc32 for r in token_files.id_checksums(token_files.read_tokens(spark, path)).collect()}
    assert all(sums[r.doc_id] == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)
    token_files.write_tokens(nothing, path + "-none", WORDS)
    assert token_files.read_tokens(spark, path + "-none").count() == 0


def test_token_files_read_by_id(spark, texts):
    path = f"{shared_folder(spark)}/tokens-{random.random()}"
    token_files.write_tokens(spark.createDataFrame(texts, "doc_id long, text string").repartition(5), path, WORDS)
    some = sorted(d for d, _ in texts if d is not None)[2:5]
    picked = token_files.read_tokens(spark, path, ids=(some[0], some[-1]))
    want = [r for r in token_files.read_tokens(spark, path).orderBy("start").collect() if r.doc_id is not None and some[0] <= r.doc_id <= some[-1]]
    assert len(want) >= 3 and picked.orderBy("start").collect() == want
    plan = picked.select("doc_id", "start")._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThanOrEqual(doc_id,{some[0]})" in plan and f"LessThanOrEqual(doc_id,{some[-1]})" in plan
    assert "ReadSchema" in plan and "ids:array" not in plan


def test_token_files_format(spark, texts):
    import glob

    import pyarrow.parquet as pq

    path = f"{shared_folder(spark)}/tokens-{random.random()}"
    token_files.write_tokens(spark.createDataFrame(texts, "doc_id long, text string"), path, WORDS)
    parts = [pq.ParquetFile(f).metadata.row_group(0) for f in glob.glob(path.removeprefix("file:") + "/*.parquet") if pq.ParquetFile(f).metadata.num_rows]
    kinds = {g.column(i).path_in_schema: set(g.column(i).encodings) for g in parts for i in range(g.num_columns)}
    assert "DELTA_BINARY_PACKED" in kinds["doc_id"] and "RLE_DICTIONARY" in kinds["ids.list.element"]
    assert all(g.column(i).has_offset_index and g.column(i).has_column_index for g in parts for i in (0, 2))


ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return ALNUM_WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute_hits(rows, items, window):
    asked = {}
    for item, text in items:
        ws = split(text)
        for i in range(max(len(ws) - window, 0) + 1 if ws else 0):
            asked.setdefault(tuple(ws[i : i + window]), set()).add(item)
    out = []
    for d, text in rows:
        ws, hits, found = split(text), set(), set()
        for phrase, ids in asked.items():
            for i in range(len(ws) - len(phrase) + 1):
                if tuple(ws[i : i + len(phrase)]) == phrase:
                    hits.update(range(i, i + len(phrase)))
                    found |= ids
        out.append((d, len(ws), sorted(hits), sorted(x for x in found if x is not None)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1 << 20, 200])
def test_decontamination(spark, monkeypatch, block):
    rng = random.Random(4)
    vocabulary = ["the", "of", "a"] * 4 + [f"t{i}" for i in range(30)] + ["Été", "ÉTÉ"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 10, 14])))) for i in range(25)] + [(3, "twice the id"), (None, "t1 of t2"), (30, None)]
    rows = list(EDGES)
    for i in range(60):
        ws = []
        for _ in range(3):
            ws += [rng.choice(vocabulary) for _ in range(rng.randrange(8))] + [rng.choice(items)[1]]
        rows.append((100 + i, rng.choice([" ", ", ", "-"]).join(w or "" for w in ws)))
    monkeypatch.setattr(decontamination, "QUERY_BYTES", block)
    monkeypatch.setattr(decontamination, "SHARD_BYTES", 500)
    got = decontamination.decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(((r.doc_id, r.n_words, r.hits, r["items"]) for r in got.collect()), key=str) == brute_hits(rows, items, 10)


def test_decontamination_index_holds_all_terms(spark, monkeypatch):
    """The query's index has the postings of all training tokens, also of words
    that no benchmark item holds."""
    kept, build = [], decontamination.build_index
    monkeypatch.setattr(decontamination, "build_index", lambda *a, **k: kept.append(build(*a, **k)) or kept[-1])
    docs = spark.createDataFrame([(1, "alpha beta gamma alpha"), (2, "delta"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "beta gamma")], "item_id long, text string")
    found = {r.doc_id: r.hits for r in decontamination.decontaminate(docs, items).collect()}
    assert found == {1: [1, 2], 2: [], 3: []}
    assert sum(len(r.positions) // 4 for r in kept[0].collect()) == 5


def test_decontamination_blocks_are_bounded(spark, monkeypatch):
    """No block that the driver collects is much above the bound, even of one
    long item, and results are those of a single block."""
    rng = random.Random(8)
    long = " ".join(f"q{rng.randrange(5000)}" for _ in range(3000))
    items = spark.createDataFrame([(1, long), (2, long), (None, long), (3, "two words")], "item_id long, text string")
    ws = long.split()
    docs = spark.createDataFrame([(1, " ".join(ws[100:140])), (2, "these two words here"), (3, long), (4, "none")], "doc_id long, text string")
    whole = sorted(map(tuple, decontamination.decontaminate(docs, items).collect()))
    sizes, collect = [], decontamination.phrases
    monkeypatch.setattr(decontamination, "phrases", lambda *a: sizes.append((q := collect(*a)).terms.size) or q)
    monkeypatch.setattr(decontamination, "QUERY_BYTES", 200_000)
    assert sorted(map(tuple, decontamination.decontaminate(docs, items).collect())) == whole
    assert [(r[0], len(r[2]), r[3]) for r in whole] == [(1, 40, [1, 2]), (2, 2, [3]), (3, 3000, [1, 2]), (4, 0, [])]
    assert len(sizes) > 3 and max(sizes) * 8 < 300_000


def test_decontamination_slack_and_empty(spark, edges, nothing):
    items = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x alpha beta gamma delta"), (2, "alpha beta well gamma delta"), (3, "alpha one two three beta gamma delta")], "doc_id long, text string")
    exact = {r.doc_id: bool(r.hits) for r in decontamination.decontaminate(docs, items).collect()}
    near = {r.doc_id: bool(r.hits) for r in decontamination.decontaminate(docs, items, slack=1).collect()}
    assert exact == {1: True, 2: False, 3: False} and near == {1: True, 2: True, 3: False}
    borders = spark.createDataFrame([(1, "alpha beta gamma x"), (2, "delta other"), (3, "alpha beta gamma"), (4, "x delta")], "doc_id long, text string").coalesce(1)
    assert not any(r.hits for slack in (1, 2, 5) for r in decontamination.decontaminate(borders, items, slack=slack).collect())
    none = items.where("false")
    assert decontamination.decontaminate(edges, none).where(F.size("hits") > 0).count() == 0
    assert decontamination.decontaminate(edges, none).count() == len(EDGES)
    assert decontamination.decontaminate(nothing, items).count() == 0


def test_known_pieces_are_not_merged_again(monkeypatch):
    encoder = tokens.word_encoder(public_tokenizers.path("word_bpe_49k.json"))
    first, second = pa.array(["Alpha beta, gamma 12", "alpha"]), pa.array(["beta alpha gamma 21,"])
    got = encoder.encode(first)[0].tolist()

    def merged(piece):
        raise AssertionError(piece)

    monkeypatch.setattr(type(encoder), "_piece", merged)
    again, counts = encoder.encode(second)
    assert sorted(again.tolist()) == sorted(got[: counts[0]]) and len(got) > counts[0]


def test_word_pieces_are_cut_as_the_library_cuts():
    """Each distinct piece is looked up once, whatever stands beside it; ids are the library's."""
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, library, seen = tokens.word_encoder(path), Tokenizer.from_file(path), []
    items = encoder._items
    encoder._items = lambda found: seen.extend(found) or items(found)
    try:
        encoder.encode(pa.array(["new words, NEW\nwords\t new... É12 é", "×words don't \x0b"]))
        assert sorted(seen) == sorted(["new", "words", ",", "...", "é", "1", "2", "×words", " don't"])
        rng = random.Random(4)
        signs = [*"aZ09 .,'<|>\t\n\x0b\x1c\x85\xa0×÷ÀÞßÿÉéµª", "é", "İ", "日本", " ", "　", "<|endoftext|>", "'s", "don't", "  "]
        texts = [None, "", " ", "\n", *("".join(rng.choice(signs) for _ in range(rng.randrange(1, 30))) for _ in range(3000))]
        ids, counts = encoder.encode(pa.array(texts))
        want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]
    finally:
        del encoder._items
