"""The pipeline's stages against brute force on a small table."""

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from obs_analytics.llm import queries
from obs_analytics.llm.checkpoints import table

from ..conftest import SF001
from .test_pairs import brute_components, brute_lines
from .test_tokens import brute_hits


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        steps[name] = (docs, table(stage(spark, docs, SF001), name))
        docs = steps[name][1]
    for name, (_, after) in list(steps.items())[:-1]:
        assert after.columns == corpus_pipeline.COLUMNS, name

    before, after = steps["quality"]
    good = {r.doc_id for r in queries.op8_quality(spark, SF001).where("predicted = 1").collect()}
    assert {d for d, _ in rows(after)} == good and dict(rows(after)).items() <= dict(rows(before)).items()

    before, after = steps["lines"]
    want = {d: kept for d, _, gone, kept in brute_lines(rows(before), 20) if not gone or kept.strip()}
    assert dict(rows(after)) == want
    assert after.where(F.length("text") != F.col("n_chars")).count() == 0

    before, after = steps["near_copies"]
    assert sorted(rows(after)) == sorted((d, t) for d, t in rows(before) if d in {c for _, _, c in brute_components(rows(before), 5, 80)})

    before, after = steps["benchmark"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    clean = {d for d, _, hits, _ in brute_hits(rows(before), items, 10) if not hits}
    assert {d for d, _ in rows(after)} == clean

    before, after = steps["tokens"]
    assert after.count() == before.count() and after.where("not round_trip").count() == 0
    assert all(len(np.frombuffer(r.ids, "<u4")) == r.n_tokens for r in after.collect())
    final = corpus_pipeline.run(spark, SF001)
    assert sorted(map(tuple, final.collect())) == sorted(map(tuple, after.collect()))


def test_edge_rows(spark):
    texts = ["x " * 30_000, "Some words of a plain text that ends well.", "Some words of a plain text that ends well.", None, ""]
    data = [(i if i < 4 else None, t, None, "s", None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(data + data[1:2], "doc_id long, text string, lang string, source string, n_chars long")
    for some in (docs, docs.where("false")):
        now = some
        for _, stage in corpus_pipeline.STAGES:
            now = table(stage(spark, now, SF001), "edge")
        assert now.where("not round_trip").count() == 0
    assert public_tokenizers.path("byte_bpe_50k.tiktoken") == corpus_pipeline.BYTE_RANKS


def test_decisions_apply_to_rows(spark):
    """Rows without an id go by their own text, a clean row stays beside a
    contaminated one of its id, and one of several equal rows stays."""
    item = next(r.text for r in spark.read.parquet(f"{SF001}/benchmark.parquet").orderBy("item_id").collect() if len(r.text.split()) >= 10)
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    frame = lambda data: spark.createDataFrame([(d, t, "en", "s", 0) for d, t in data], "doc_id long, text string, lang string, source string, n_chars long")

    def left(stage, data):
        return sorted(rows(stage(spark, frame(data), SF001)), key=str)

    got = left(corpus_pipeline.uncontaminated, [(1, item), (1, "clean words"), (None, "x " + item), (None, "no phrase"), (None, None), (2, None)])
    assert got == sorted([(1, "clean words"), (None, "no phrase"), (None, None), (2, None)], key=str)

    data = [(5, a), (9, b), (None, a), (None, b), (7, "one row"), (7, "one row"), (7, "another text"), (None, c), (None, c), (None, c + " z"), (None, ""), (None, "")]
    got = left(corpus_pipeline.one_of_each_group, data)
    rest = [r for r in got if r[0] is not None or not r[1]]
    assert rest == sorted([(5, a), (9, b), (7, "one row"), (7, "another text"), (None, ""), (None, "")], key=str)
    assert len(got) == len(rest) + 1 and set(got) - set(rest) <= {(None, c), (None, c + " z")}
