"""Document fingerprints (operator 2): bottom-k sketches of shingle hashes.

A fingerprint is the sorted array of the ``k`` smallest hashes of a text's
distinct shingles (runs of ``width`` words; fewer words are one shingle, no
word is none). Fingerprints of parts merge into the fingerprint of the whole,
and two of them estimate resemblance, containment and the number of distinct
shingles; sets of up to ``k`` shingles are compared exactly. All of it is
column expressions.

Defined results: null, empty and wordless texts have the empty fingerprint;
two empty fingerprints resemble each other fully, an empty and another one not
at all; equal texts have equal fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, WIDTH = 128, 5
LAST = (1 << 63) - 1  # place of rows without an id
BUCKET_ROWS, MOST_BUCKETS = 512, 2048


def fingerprint(text: Column, *, k: int = K, width: int = WIDTH) -> Column:
    """Sorted array of the k smallest distinct shingle hashes."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    runs = lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(width))))
    one = lambda h: F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
    # transform over a one-element array binds the hashes once
    shingles = F.transform(F.array(hashes), lambda h: F.when(F.size(h) >= width, runs(h)).otherwise(one(h)))
    return F.slice(F.sort_array(F.array_distinct(F.get(shingles, F.lit(0)))), 1, k)


def merged(a: Column, b: Column, *, k: int = K) -> Column:
    """Fingerprint of the union of two shingle sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_parts(parts: DataFrame, by: str, column: str, *, k: int = K) -> DataFrame:
    """Fingerprint per ``by`` of the union of its rows' fingerprints. Each task
    keeps at most k values of a group before the shuffle, whatever its size."""
    values = parts.select(by, F.explode(column).alias("value")).distinct()
    rank = F.row_number().over(Window.partitionBy(by).orderBy("value"))
    lowest = values.withColumn("rank", rank).where(F.col("rank") <= k).groupBy(by).agg(F.sort_array(F.collect_list("value")).alias(column))
    none = parts.groupBy(by).agg(F.count("*").alias("n")).select(by)
    return none.join(lowest, by, "left").withColumn(column, F.coalesce(column, F.array().cast("array<bigint>")))


def resemblance(a: Column, b: Column, *, k: int = K) -> Column:
    """Estimated Jaccard likeness, 0 to 1."""
    union = merged(a, b, k=k)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(both / F.greatest(F.size(union), F.lit(1)))


def distinct_shingles(a: Column, *, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    largest = F.element_at(a, -1).cast("double") + F.lit(2.0**63)  # 0 .. 2^64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * F.lit(2.0**64) / largest)


def containment(a: Column, b: Column, *, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds, 0 to 1 (1 for an empty a)."""
    like = resemblance(a, b, k=k)
    shared = like * distinct_shingles(merged(a, b, k=k), k=k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k=k)))


def as_string(a: Column) -> Column:
    """The fingerprint as 16 hex digits per hash."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def with_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """(doc_id, text, fingerprint, next_text, next_fingerprint), where next is the
    document with the next id (after the last the first; rows without an id
    come last, rows that share an id are ordered by a hash of their text).

    Rows are dealt by ranges of ids, each a window of its own, and the first
    row of a range also goes to the range before it. The range bounds (at most
    ``MOST_BUCKETS``) and first rows' keys are all that the driver sees."""
    doc_id = docs[id_col].cast("long")
    rows = docs.select(F.coalesce(doc_id, F.lit(LAST)).alias("place"), F.xxhash64(docs[text_col]).alias("text_key"), docs[text_col].alias("text"))
    keys = rows.select("place", "text_key")
    n = min(MOST_BUCKETS, max(1, keys.count() // BUCKET_ROWS))
    bounds = keys.agg(F.percentile_approx("place", [i / n for i in range(1, n)] or [0.5], 20 * n).alias("b")).first().b or []
    bucket = F.size(F.filter(F.array(*map(F.lit, sorted(set(bounds)))).cast("array<bigint>"), lambda b: b < F.col("place")))
    starts = sorted(keys.groupBy(bucket.alias("bucket")).agg(F.min(F.struct("place", "text_key")).alias("key")).collect(), key=lambda r: r.bucket)
    halo = [(r.key.place, r.key.text_key, starts[i - 1].bucket) for i, r in enumerate(starts)]
    firsts = docs.sparkSession.createDataFrame(halo, "place long, text_key long, before int")
    to = F.array(F.struct(bucket.alias("bucket"), F.lit(0).alias("halo")))
    to = F.when(F.col("before").isNull(), to).otherwise(F.concat(to, F.array(F.struct(F.col("before").alias("bucket"), F.lit(1).alias("halo")))))
    dealt = rows.join(F.broadcast(firsts), ["place", "text_key"], "left").select("place", "text_key", "text", F.explode(to).alias("to"))
    ranged = dealt.select("place", "text_key", "text", "to.bucket", "to.halo").repartition("bucket").withColumn("fingerprint", fingerprint(F.col("text"), k=k))
    order = Window.partitionBy("bucket").orderBy("halo", "place", "text_key")
    paired = ranged.select("place", "halo", "text", "fingerprint", F.lead("text").over(order).alias("next_text"), F.lead("fingerprint").over(order).alias("next_fingerprint"))
    return paired.where("halo = 0").select(F.nullif("place", F.lit(LAST)).alias("doc_id"), "text", "fingerprint", "next_text", "next_fingerprint")
