"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents. All but the last
return the columns of documents.

Decisions are taken back to the rows by id (also a null id) and text: rows that
share an id but not their text are judged each by its own text, except that
near_copies compares them as one document and lets one of equal rows with words stay.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obs_analytics.llm import byte_bpe, decontamination, jaccard_join, line_dedup, quality
from obs_analytics.llm.checkpoints import table
from obs_analytics.llm.labelled import fold
from obs_analytics.llm.shipping import ship

BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _same_row(docs: DataFrame, keys: DataFrame) -> Column:
    """Whether a document has an id and text of ``keys`` (id, text_key)."""
    return docs["doc_id"].eqNullSafe(keys["id"]) & (F.xxhash64(docs["text"]) == keys["text_key"])


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality discriminant scores 0.5 or more. It learns
    from all labels outside the held-out fold."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold(F.col("doc_id"), 3) != 1)
    vectors = quality.measured(docs)
    model = quality.train(vectors, labels.select("doc_id", F.col("quality").alias("label")))
    good = quality.score(vectors, model).where("score >= 0.5").select(F.col("doc_id").alias("id"), "text_key")
    return docs.join(good, _same_row(docs, good), "left_semi").select(COLUMNS)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line equals or is one edit
    away from; a document that loses all its text goes."""
    ship(spark)
    found = line_dedup.line_dedup(docs, carry=["lang", "source"])
    left = found.where((F.col("n_removed") == 0) | F.col("kept").rlike(r"\S"))
    return left.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group linked by a Jaccard likeness of 0.8 or
    more over five-word shingles; wordless texts link with nothing and stay."""
    ship(spark)
    found = table(jaccard_join.jaccard_join(docs, width=5, percent=80, keyed=True).select(F.col("doc_id").alias("id"), "text_key", "n_shingles", "leads"), "groups")
    later = found.where("not leads").select("id", "text_key")
    repeated = found.where("leads and n_shingles > 0").groupBy("id", "text_key").count().where("count > 1").select("id", "text_key")
    once = docs.join(repeated, _same_row(docs, repeated), "left_semi").select(COLUMNS).dropDuplicates(["doc_id", "text"])
    gone = later.union(repeated)
    return docs.join(gone, _same_row(docs, gone), "left_anti").select(COLUMNS).union(once)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word phrase of a benchmark item."""
    ship(spark)
    found = decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keyed=True)
    hit = found.where(F.size("hits") > 0).select(F.col("doc_id").alias("id"), "text_key")
    return docs.join(hit, _same_row(docs, hit), "left_anti").select(COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids (little-endian unsigned 32-bit) of each text, and
    whether decoding them gives the text back."""
    ship(spark)
    encoded = byte_bpe.encode(docs, BYTE_RANKS, public_tokenizers.PATTERN, keep_text=True)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return byte_bpe.decode(encoded, BYTE_RANKS).select("doc_id", "n_tokens", "ids", same.alias("round_trip"))


STAGES = [
    ("quality", good_documents),
    ("lines", distinct_lines),
    ("near_copies", one_of_each_group),
    ("benchmark", uncontaminated),
    ("tokens", token_ids),
]

#: SQL cannot express the trained quality stage; tests compare it with a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
