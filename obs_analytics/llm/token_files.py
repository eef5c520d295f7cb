"""Token-ID output (operator 7): Parquet files of id lists in document order.

Files hold one row per document in ascending id order: its id, where its ids
start within the file's part, their number, and the ids as a list column. Ids
are dictionary coded (16 bits each for a 49k vocabulary), the sorted integer
columns delta coded; row groups and pages are small, and their minima, maxima
and page indexes let a reader fetch single documents or metadata alone.

Defined results: a null text counts as empty and holds the end id only; rows
without an id come first; rows that repeat an id are kept, ordered by a hash
of their text; an empty table gives files without rows; further columns are
left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obs_analytics.llm import arrays, tokens

FILE_SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"
ROW_GROUP_BYTES, PAGE_BYTES = 16 << 20, 128 << 10
#: Text per slice: a word that repeats in a slice is looked up once.
SLICE_BYTES = 8 << 20


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, *, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode and write the files below ``path``. One shuffle: rows are dealt by
    ranges of the id, so file order is document order."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, total = tokens.word_encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in arrays.slices(batch, "text", SLICE_BYTES):
                ids, counts = encoder.encode(piece.column(1))
                ends = np.cumsum(counts)
                ids, counts = np.insert(ids, ends, end_id), counts + 1
                starts = total + np.cumsum(counts) - counts
                total += int(counts.sum())
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(np.full(len(counts), part, np.int32)), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), arrays.list_array(pa.array(ids.view(np.int32)), counts)],
                    names=["doc_id", "part", "part_start", "n_tokens", "ids"],
                )

    (
        ordered.mapInArrow(run, FILE_SCHEMA).write.mode("errorifexists")
        .option("compression", "zstd").option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES)
        .option("parquet.enable.dictionary", "true")
        .option("parquet.enable.dictionary#doc_id", "false").option("parquet.enable.dictionary#part_start", "false")
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str, *, ids: tuple[int, int] | None = None) -> DataFrame:
    """The files' rows with ``start``: the number of ids of all documents before
    the row. With ``ids`` only the documents of that closed range, whose bounds
    reach the scan, so that other row groups and pages are passed over. Only the parts' totals, one small row per write task, are summed up
    and broadcast (16 bytes each, so 16 MB for a million tasks)."""
    rows = spark.read.schema(FILE_SCHEMA).parquet(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = totals.select("part", F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    if ids is not None:
        rows = rows.where(F.col("doc_id").between(*ids))
    return rows.join(F.broadcast(before), "part").select("doc_id", (F.col("before") + F.col("part_start")).alias("start"), "n_tokens", "ids")


def id_checksums(rows: DataFrame) -> DataFrame:
    """``ids`` replaced by ``ids_crc32``: the CRC-32 of the ids as little-endian
    unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            ends = lists.offsets.to_numpy()
            data = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
            sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
