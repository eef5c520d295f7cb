"""Line dedup (operator 5): a deletion-neighbourhood join, keeping the earliest.

A line is dropped when an earlier line of the corpus (smaller document id, or
same document and smaller line number) is equal to it or one edit away: one
character replaced, inserted or deleted. Lines shorter than ``least``
characters have near neighbours by chance and are compared for equality only:
later exact repeats of non-blank lines of ``shortest`` or more characters go,
by default of every non-blank line.

Equal lines are first reduced to one row with their earliest place. Every line
then emits its variants, itself and each string with one character deleted, as
hashed keys. Two lines are one insertion apart when one equals the other's
variant, and one replacement apart when their variants without the character
at the same position are equal, so the grouped minimum of a key already names
an earlier neighbour: groups are never expanded into pairs. The neighbour that
is found is verified by edit distance on the texts.

Only lines that can have a neighbour emit variants: one edit leaves the first
or the second half of a line as it was, so a line of which neither half recurs
in another line of fitting length has none, and the half-line keys (four per
line) tell so without its text.

All work is DataFrame expressions. Keys are 64-bit hashes; lines are told
apart by 128 bits, and a false key match is caught by the verification.

Defined results: a null text counts as empty, and an empty text is one empty
line; rows without an id come last; rows that share an id are one document
whose lines of equal number are not ordered; an empty table gives an empty
table; further columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obs_analytics.llm.checkpoints import table

LAST = (1 << 63) - 1  # place of rows without an id
LEAST = 20


def _half_keys(line: Column, size: Column) -> Column:
    """Keys of a line's halves, as the shorter or equal (its own length) and as
    the longer (one less) line of a pair."""

    def pair(s: Column) -> list[Column]:
        half = F.floor(s / 2).cast("int")
        return [F.xxhash64(F.lit(0), s, F.left(line, half)), F.xxhash64(F.lit(1), s, F.right(line, s - half))]

    return F.array(*pair(size), *pair(size - 1))


def line_dedup(docs: DataFrame, *, least: int = LEAST, shortest: int = 1, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed and ``kept``, its remaining lines
    joined by newlines, after them the columns in ``carry``."""
    others = [F.struct(*(docs[c].alias(f"c{i}") for i, c in enumerate(carry))).alias("others")] if carry else []
    doc_id = docs[id_col].cast("long")
    rows = docs.select(F.coalesce(doc_id, F.lit(LAST)).alias("place"), F.xxhash64(docs[text_col]).alias("text_key"), F.coalesce(docs[text_col], F.lit("")).alias("text"), *others)
    line, size = F.col("line"), F.length("line")

    def compared(line: Column) -> Column:
        return (F.length(line) >= least) | ((F.length(line) >= shortest) & line.rlike(r"\S"))

    order = F.col("place").cast("decimal(38,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.col("no")

    lines = rows.select("place", "text_key", F.posexplode(F.split("text", "\n")).alias("no", "line")).where(compared(line))
    halves = F.when(size >= least, _half_keys(line, size)).otherwise(F.array().cast("array<bigint>"))
    marked = lines.select("place", "text_key", "no", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("g"), halves.alias("halves"))
    distinct = marked.groupBy("h", "g").agg(F.min(F.struct("place", "no", "text_key")).alias("first"), F.first("halves").alias("halves"))
    distinct = table(distinct.select("h", "first.place", "first.text_key", "first.no", "halves"), "lines").withColumn("at", order.cast("decimal(38,0)"))

    halves = distinct.select("h", F.explode("halves").alias("key"))
    shared = halves.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a <> b").select("key")
    live = halves.join(shared, "key", "left_semi").select("h").distinct()
    asked = distinct.join(live, "h", "left_semi").groupBy("place", "text_key").agg(F.collect_list(F.struct("no", "h", "at")).alias("asked"))
    texts = rows.join(asked, ["place", "text_key"]).select(F.split("text", "\n").alias("lines"), F.explode("asked").alias("a"))
    texts = texts.select("a.h", "a.at", F.get("lines", F.col("a.no")).alias("line")).dropDuplicates(["h", "at"])
    # read three times below, from one exchange; a line becomes as many variants as it has characters
    texts = texts.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "h")

    near, kept = neighbours(texts), ["others"] if carry else []
    dropped = near.where(F.levenshtein("line", "other", 1) >= 0).select("h", "at")
    firsts = distinct.join(dropped, ["h", "at"], "left_anti").groupBy("place", "text_key").agg(F.collect_list("no").alias("firsts"))
    numbered = rows.join(firsts, ["place", "text_key"], "left").select("place", *kept, F.split("text", "\n").alias("lines"), F.coalesce("firsts", F.array().cast("array<int>")).alias("firsts"))
    numbers = F.sequence(F.lit(0), F.size("lines") - 1)
    judged = F.filter(numbers, lambda i: compared(F.get("lines", i)))
    left = numbered.select("place", *kept, "lines", F.array_except(numbers, F.array_except(judged, "firsts")).alias("left"))
    return left.select(
        F.nullif("place", F.lit(LAST)).alias("doc_id"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("left")).cast("long").alias("n_removed"),
        F.array_join(F.transform("left", lambda i: F.get("lines", i)), "\n").alias("kept"),
        *(F.col(f"others.c{i}").alias(c) for i, c in enumerate(carry or [])),
    )


def neighbours(lines: DataFrame) -> DataFrame:
    """(h, at, line, other): each line (h, at, line; distinct texts) that has an
    earlier line among its deletion neighbours by key, and the earliest such.
    Variants and whole lines meet on one exchange by their key."""
    at_each = F.sequence(F.lit(1), F.length("line"))
    without = lambda i: F.xxhash64(F.concat(F.left("line", i - 1), F.substr("line", i + 1)))
    whole = F.array(F.struct(F.lit(0).alias("i"), F.xxhash64("line").alias("v")))
    variants = F.concat(whole, F.transform(at_each, lambda i: F.struct(i.alias("i"), without(i).alias("v"))))
    keyed = lines.select("h", "at", F.explode(variants).alias("x")).select("h", "at", "x.i", "x.v")
    place = F.struct("at", "h")
    same = F.min(place).over(Window.partitionBy("v", "i"))  # one character replaced
    longer = F.min(F.when(F.col("i") > 0, place)).over(Window.partitionBy("v"))  # one inserted in the other
    shorter = F.min(F.when(F.col("i") == 0, place)).over(Window.partitionBy("v"))  # one deleted in the other
    met = keyed.repartition("v").select("h", "at", F.when(F.col("i") == 0, longer).otherwise(F.least(same, shorter)).alias("near"))
    found = met.where("near.at < at").groupBy("h", "at").agg(F.min("near.at").alias("first"), F.min_by("near.h", "near.at").alias("other"))
    others = lines.select(F.col("h").alias("other"), F.col("at").alias("first"), F.col("line").alias("other_line"))
    return lines.join(found, ["h", "at"]).join(others, ["other", "first"]).select("h", "at", "line", F.col("other_line").alias("other"))
