"""Byte-level BPE encoding and decoding (operator 4).

``encode`` maps texts to the ids of a byte-level BPE and, on request, the
character offsets of each token; ``decode`` reverses the byte table. Both run
as Arrow batches, without a shuffle.

Defined results: a null text counts as empty and has no ids; a null id column
value is carried through; repeated rows each give their row; an empty table
gives an empty table; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from obs_analytics.llm import arrays, tokens


def encode(docs: DataFrame, rank_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", offsets: bool = False, keep_text: bool = False) -> DataFrame:
    """Per document: doc_id, n_tokens and ``ids`` (little-endian unsigned 32-bit
    integers). With ``offsets`` also ``starts`` and ``ends``: the half-open
    range of characters that each token's bytes touch, so tokens that split a
    character share it. With ``keep_text`` the text stays beside its ids."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.rank_encoder(rank_path, pattern)
        width = np.array([len(t) for t in tokens.read_ranks(rank_path)]) if offsets else None
        for batch in batches:
            for part in arrays.slices(batch, "text", tokens.SLICE_BYTES):
                ids, counts = encoder.encode(part.column(1))
                out = [part.column(0), pa.array(counts, pa.int64()), arrays.binaries(ids.astype("<u4").tobytes(), counts * 4)]
                if offsets:
                    out += [arrays.list_array(pa.array(x, pa.int32()), counts) for x in _characters(part.column(1), width[ids], counts)]
                if keep_text:
                    out.append(part.column(1))
                yield pa.RecordBatch.from_arrays(out, names=names)

    names = ["doc_id", "n_tokens", "ids"] + ["starts", "ends"] * offsets + ["text"] * keep_text
    schema = "doc_id long, n_tokens long, ids binary" + ", starts array<int>, ends array<int>" * offsets + ", text string" * keep_text
    return rows.mapInArrow(run, schema)


def _characters(texts: pa.Array, width: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and end character of each token, from its byte width."""
    data, offsets = arrays.buffers(texts)
    index = np.cumsum((data & 0xC0) != 0x80) - 1  # character of each byte, over all texts
    ends = np.cumsum(width)
    before = np.repeat(np.append(index, len(index))[offsets[:-1]] if len(index) else np.zeros(len(counts), np.int64), counts)
    return index[ends - width] - before, index[ends - 1] + 1 - before


def decode(encoded: DataFrame, rank_path: str, *, as_text: bool = False) -> DataFrame:
    """The encoded rows with ``decoded``: the bytes of their ids, joined, so a
    character that tokens split is whole again. With ``as_text`` they are read
    as UTF-8; bytes that are no character (cut id lists) become U+FFFD. Null
    ids count as none; an id without a token is an error."""
    names = [f.name for f in encoded.schema if f.name != "decoded"]
    rows = encoded.select(names)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = tokens.read_ranks(rank_path)
        flat, width = np.frombuffer(b"".join(table), np.uint8), np.array([len(t) for t in table])
        begin, at = np.cumsum(width) - width, names.index("ids")
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                column = part.column(at).fill_null(b"")
                sizes = np.fromiter((len(x.as_buffer()) for x in column), np.int64, len(column)) // 4
                ids = np.frombuffer(b"".join(column.to_pylist()), "<u4")
                data = flat[np.repeat(begin[ids], width[ids]) + arrays.ramp(width[ids])].tobytes()
                ends = np.concatenate([[0], np.cumsum(width[ids])])
                counts = np.diff(ends[np.concatenate([[0], np.cumsum(sizes)])])
                made = arrays.binaries(data, counts)
                if as_text:
                    made = pa.array([x.decode("utf-8", "replace") for x in made.to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*names, "decoded"])

    return rows.mapInArrow(run, f"{schema}, decoded {'string' if as_text else 'binary'}")
