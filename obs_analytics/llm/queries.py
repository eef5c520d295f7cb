"""Registered queries of the operators in this package, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obs_analytics.llm import byte_bpe, collocations, decontamination, fingerprints, hard_negatives, jaccard_join, language, line_dedup, quality, simhash, substring_dedup, token_files, toxicity
from obs_analytics.llm.checkpoints import shared_folder
from obs_analytics.llm.labelled import fold
from obs_analytics.llm.shipping import ship

BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = fingerprints.with_next(read(spark, sf_dir, "documents"))
    text, cut = F.coalesce("text", F.lit("")), F.floor(F.length(F.coalesce("text", F.lit(""))) / 4).cast("int")
    edited = pairs.select(
        "doc_id", "fingerprint", "next_fingerprint", F.length(text).cast("long").alias("n_chars"),
        F.concat(F.left(text, F.length(text) - cut), F.left(F.coalesce("next_text", F.lit("")), cut)).alias("edited"),
    )
    both = edited.withColumn("edited_fingerprint", fingerprints.fingerprint(F.col("edited")))
    like = lambda other: fingerprints.resemblance(F.col("fingerprint"), F.col(other))
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_string(F.col("fingerprint")).alias("fingerprint"),
        fingerprints.as_string(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        like("edited_fingerprint").alias("near_edited"),
        like("next_fingerprint").alias("near_next"),
    )


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = read(spark, sf_dir, "documents"), fold(F.col("doc_id"), 3) == 1
    model = language.train(docs.select("doc_id", "text"), docs.where(~held_out).select("doc_id", F.col("lang").alias("label")))
    return language.identify(docs, model).select("doc_id", F.coalesce(held_out, F.lit(True)).alias("held_out"), "lang_pred", "score")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode(read(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, BYTE_RANKS).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(read(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    path = f"{shared_folder(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    token_files.write_tokens(read(spark, sf_dir, "documents"), path, WORD_TOKENIZER)
    return token_files.id_checksums(token_files.read_tokens(spark, path))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 3) == 1
    labels = read(spark, sf_dir, "labels").where(~held_out).select("doc_id", F.col("quality").alias("label"))
    vectors = quality.measured(read(spark, sf_dir, "documents"))
    scored = quality.score(vectors, quality.train(vectors, labels))
    return scored.select("doc_id", F.coalesce(held_out, F.lit(True)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.col("items").cast("array<string>")), ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = read(spark, sf_dir, "documents"), fold(F.col("doc_id"), 5) == 0
    labels = read(spark, sf_dir, "labels").where(~held_out).select("doc_id", F.col("toxic").alias("label"))
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.select("doc_id", F.coalesce(held_out, F.lit(True)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("spans").alias("n_spans"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(read(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, seventh = read(spark, sf_dir, "embeddings"), F.col("vec_id") % 7 == 0
    label = F.col("label").cast("long")
    vectors = vectors.withColumn("label", F.when(seventh, (label + 1) % 10).otherwise(label))
    return hard_negatives.hard_negatives(vectors, anchor=vectors["vec_id"] % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_fingerprints": op2_fingerprints,
    "op3_language": op3_language,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_line_dedup": op5_line_dedup,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_token_files": op7_token_files,
    "op8_quality": op8_quality,
    "op9_decontamination": op9_decontamination,
    "op10_toxicity": op10_toxicity,
    "op11_collocations": op11_collocations,
    "op12_simhash": op12_simhash,
    "op13_hard_negatives": op13_hard_negatives,
}

_OP1 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), win AS (
  SELECT doc_id, i AS start, list_aggregate(list_slice(ws, i, i + 19), 'string_agg', ' ') AS seq
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 18, 1))) AS i FROM words)
), again AS (
  SELECT doc_id, start FROM (
    SELECT doc_id, start, row_number() OVER (PARTITION BY seq ORDER BY doc_id, start) AS n FROM win
  ) WHERE n > 1
), covered AS (
  SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS pos FROM again
), word AS (
  SELECT doc_id, i AS pos, ws[i] AS w FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM words)
), kept AS (
  SELECT word.doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY pos) AS text
  FROM word ANTI JOIN covered USING (doc_id, pos) GROUP BY word.doc_id
)
SELECT words.doc_id, cast(len(ws) AS BIGINT) AS n_words, cast(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

_OP5 = r"""
WITH line AS (
  SELECT doc_id, i - 1 AS no, ls[i] AS line
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))
), kind AS (
  SELECT line, length(line) AS n, min((doc_id, no)) AS first FROM line WHERE length(line) >= 20 OR regexp_matches(line, '[^ \t\n\x0B\f\r]') GROUP BY line
), cand AS (
  SELECT a.line AS x, b.line AS y, a.n AS n, b.n AS m FROM kind a JOIN kind b ON left(a.line, 10) = left(b.line, 10)
  WHERE a.n >= 20 AND b.n >= 20 AND a.line <> b.line AND a.n - b.n BETWEEN -1 AND 1 AND b.first < a.first
  UNION
  SELECT a.line, b.line, a.n, b.n FROM kind a JOIN kind b ON right(a.line, 10) = right(b.line, 10)
  WHERE a.n >= 20 AND b.n >= 20 AND a.line <> b.line AND a.n - b.n BETWEEN -1 AND 1 AND b.first < a.first
), near AS (
  SELECT DISTINCT x FROM cand WHERE len(list_filter(range(0, greatest(n, m)), lambda i:
    left(x, i) = left(y, i) AND substr(x, i + (CASE WHEN n >= m THEN 2 ELSE 1 END)) = substr(y, i + (CASE WHEN m >= n THEN 2 ELSE 1 END)))) > 0
), stays AS (
  SELECT first FROM kind ANTI JOIN near ON near.x = kind.line
)
SELECT doc_id, cast(count(*) AS BIGINT) AS n_lines, cast(count(*) FILTER (gone) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT gone), '')) AS kept_sha256
FROM (SELECT line.*, (length(line) >= 20 OR regexp_matches(line, '[^ \t\n\x0B\f\r]')) AND first IS NULL AS gone FROM line LEFT JOIN stays ON stays.first = (doc_id, no))
GROUP BY doc_id
"""

_OP6 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents
), gram AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 2), ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i FROM words WHERE len(ws) > 0)
), size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id
), link AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM gram a JOIN gram b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN size s ON s.doc_id = a.doc_id JOIN size t ON t.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, s.n, t.n
  HAVING 100 * count(*) >= 90 * (s.n + t.n - count(*))
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM words
  UNION
  SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y
), least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT words.doc_id, cast(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM words LEFT JOIN size USING (doc_id) JOIN least ON least.x = words.doc_id
"""

_OP9 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), win AS (
  SELECT DISTINCT item_id, array_to_string(list_slice(ws, i, i + 9), ' ') AS seq, least(len(ws), 10) AS n
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM item WHERE len(ws) > 0)
), sizes AS (SELECT DISTINCT n FROM win
), run AS (
  SELECT doc_id, i AS start, n, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS seq
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM words, sizes)
), found AS (
  SELECT doc_id, start, n, item_id FROM run JOIN win USING (seq, n)
), hit AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(start, start + n)) AS pos FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, cast(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT words.doc_id, cast(len(ws) AS BIGINT) AS n_words, cast(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       cast(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP11 = r"""
WITH doc AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
         regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents
), piece AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM (SELECT lang, unnest(pieces) AS p FROM doc)
), words AS (
  SELECT lang, cast(sum(len(ws)) AS BIGINT) AS n FROM piece GROUP BY lang
), f AS (
  SELECT lang, phrase, count(*) AS a
  FROM (SELECT lang, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS phrase
        FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM piece, (SELECT unnest([1, 2, 3]) AS k) WHERE len(ws) >= k))
  GROUP BY lang, phrase HAVING count(*) >= 10
), cand AS (
  SELECT lang, phrase, a, string_split(phrase, ' ') AS g FROM f WHERE contains(phrase, ' ')
), halves AS (
  SELECT lang, phrase, a, k, array_to_string(list_slice(g, 1, k), ' ') AS head, array_to_string(list_slice(g, k + 1, len(g)), ' ') AS tail
  FROM (SELECT *, unnest(range(1, len(g))) AS k FROM cand)
), cut AS (
  SELECT h.lang, h.phrase, h.a, h.k, x.a AS l, y.a AS r,
         cast(cast(1000000 AS HUGEINT) * h.a * h.a // (cast(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM halves h JOIN f x ON x.lang = h.lang AND x.phrase = h.head JOIN f y ON y.lang = h.lang AND y.phrase = h.tail
), best AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, a, unnest([array_to_string(list_slice(g, 1, 2), ' '), array_to_string(list_slice(g, 2, 3), ' ')]) AS phrase FROM cand WHERE len(g) = 3
), covered AS (
  SELECT DISTINCT c.lang, c.phrase FROM cand c JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase WHERE 100 * i.a >= 50 * c.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best ANTI JOIN covered USING (lang, phrase) JOIN words USING (lang)
QUALIFY rank <= 2000
"""

_OP13 = r"""
WITH vec AS (
  SELECT vec_id, cast(CASE WHEN vec_id % 7 = 0 THEN (cast(label AS BIGINT) + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: floor(256 * cast(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, cast(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM vec a JOIN vec b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positive AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), negative AS (
  SELECT anchor_id, positive_id, cast(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
         id AS negative_id, positive_score, score AS negative_score
  FROM positive JOIN scored USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT * FROM negative WHERE rank <= 10
"""

SQL: dict[str, str] = {"op1_substring_dedup": _OP1, "op5_line_dedup": _OP5, "op6_jaccard_join": _OP6, "op9_decontamination": _OP9, "op11_collocations": _OP11, "op13_hard_negatives": _OP13}
