"""SimHash near-dedup (operator 12) with Golay-code fuzzy hashing.

A text's fingerprint has a bit set where more than half the hashes of its word
shingles have it (repeats count). Fingerprints that differ in at most four bits
link; linked documents are one component.

1. Documents with one fingerprint are one class, reduced before the shuffle.
2. The 64 bits are cut into three segments of up to 23 bits. Of four errors at
   most two fall into the two segments that hold the fewest, so two linked
   fingerprints agree but for two errors in one of the three pairs of segments.
3. The binary Golay code (23, 12) is perfect: each word is within three errors
   of exactly one codeword. If two words differ in two bits, the word between
   them is one error from both. A fingerprint's keys are therefore the codeword
   indices of its pair of segments, as it is and with each single bit changed:
   about ten keys of 24 bits for each pair, and linked fingerprints share a key.
4. Classes that share a key are compared bit by bit. A key of many classes is
   cut by hash into blocks, and each pair of blocks is one task. A task returns
   a spanning forest of its links, never all pairs.
5. Connected components of the links, taken back to the documents.

Cost: a key has 24 bits, so of n distinct fingerprints about 30 n (10 n / 2^24)
pairs are compared by chance, a few operations on a 64-bit word each.

Defined results: null, empty and wordless texts have fingerprint zero and link
like any other; ties (equal fingerprints) are one class; rows that share an id
are documents of their own; rows without an id link, but a component is named
after its smallest id, null if it has none; an empty table gives an empty table;
further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obs_analytics.llm import arrays
from obs_analytics.llm.checkpoints import table
from obs_analytics.llm.graph import components

SEED = 42
GENERATOR = 0b110001110101  # of the (23, 12) Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (lowest bit, bits)
ERRORS = 4
MOST = 4096  # classes that a task compares with each other, or half of them
FEW = 32  # classes of a key that are compared place by place
SALTS = 8  # tasks to which the documents of one fingerprint are dealt


def _shingle_hashes(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(XXH64 of every shingle, number of shingles of each text)."""
    data, offsets = arrays.buffers(texts)
    data = arrays.LOWER[data]
    starts, ends, first = arrays.spans(data, offsets, arrays.SPACE[data] == 0)
    length = ends - starts
    # words joined by single spaces; a shingle is a span of this
    to = np.cumsum(length + 1) - length - 1
    joined = np.full(int((length + 1).sum()), 0x20, np.uint8)
    step = arrays.ramp(length)
    joined[np.repeat(to, length) + step] = data[np.repeat(starts, length) + step]
    words = np.diff(first)
    count = np.where(words >= width, words - width + 1, np.minimum(words, 1))
    at = np.repeat(first[:-1], count) + arrays.ramp(count)
    last = at + np.repeat(np.minimum(words, width), count) - 1
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    spans = zip(to[at].tolist(), (to[last] + length[last]).tolist(), strict=True)
    return np.fromiter((digest(view[a:b], SEED) for a, b in spans), arrays.U64, len(at)), count


def fingerprints(texts: pa.Array, width: int = 4) -> np.ndarray:
    """64-bit fingerprint of each text."""
    hashes, count = _shingle_hashes(texts, width)
    out = np.zeros(len(count), arrays.U64)
    some = np.flatnonzero(count)
    if len(some):
        ones = np.add.reduceat(np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64), (np.cumsum(count) - count)[some], axis=0, dtype=np.int32)
        out[some] = np.packbits(2 * ones > count[some][:, None], axis=1, bitorder="little").view(arrays.U64).ravel()
    return out


@cache
def _golay() -> tuple[np.ndarray, np.ndarray]:
    """(syndrome of each 23-bit word, error of least weight of each syndrome)."""
    bit = np.zeros(23, np.int32)
    for i in range(23):  # x^i modulo the generator
        bit[i] = 1 << i if i < 11 else bit[i - 1] << 1
        if bit[i] >> 11:
            bit[i] ^= GENERATOR
    syndrome = np.zeros(1 << 23, np.int16)
    for i in range(23):
        syndrome[1 << i : 2 << i] = syndrome[: 1 << i] ^ np.int16(bit[i])
    one = np.int32(1) << np.arange(23, dtype=np.int32)
    two = (one[:, None] | one).ravel()
    errors = np.unique(np.concatenate([[0], (two[:, None] | one).ravel()]))  # up to three bits
    table_of = np.zeros(1 << 11, np.int32)
    table_of[syndrome[errors]] = errors
    return syndrome, table_of


def codeword_index(words: np.ndarray) -> np.ndarray:
    """The 12 data bits of the codeword nearest to each 23-bit word."""
    syndrome, error = _golay()
    return (words ^ error[syndrome[words]]) >> 11


def segment_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, index of the fingerprint): distinct keys of each fingerprint."""
    parts = [((prints >> arrays.U64(low)) & arrays.U64((1 << bits) - 1)).astype(np.int32) for low, bits in SEGMENTS]
    own = [codeword_index(p) for p in parts]
    near = [np.stack([codeword_index(p ^ np.int32(1 << i)) for i in range(bits)], 1) for p, (_, bits) in zip(parts, SEGMENTS, strict=True)]
    keys, owners = [], []
    for pair, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
        codes = np.concatenate([(own[a] << 12 | own[b])[:, None], near[a] << 12 | own[b][:, None], own[a][:, None] << 12 | near[b]], 1)
        codes.sort(1)
        new = np.ones(codes.shape, bool)
        new[:, 1:] = codes[:, 1:] != codes[:, :-1]
        keys.append(codes[new] | pair << 24)
        owners.append(np.nonzero(new)[0])
    return np.concatenate(keys), np.concatenate(owners)


def spanning_links(prints: np.ndarray, errors: int = ERRORS) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all fingerprints that links connect, none to spare: a
    walk that compares each one with those not yet reached."""
    rest, a, b = np.arange(len(prints)), [], []
    while len(rest):
        waiting, rest = [rest[0]], rest[1:]
        while waiting and len(rest):
            now = waiting.pop()
            close = np.bitwise_count(prints[rest] ^ prints[now]) <= errors
            if close.any():
                reached = rest[close]
                a.append(np.full(len(reached), now))
                b.append(reached)
                waiting.extend(reached)
                rest = rest[~close]
    none = np.zeros(0, np.int64)
    return prints[np.concatenate([none, *a])], prints[np.concatenate([none, *b])]


def group_links(task: np.ndarray, prints: np.ndarray, errors: int = ERRORS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of each run of equal tasks."""
    edges = np.flatnonzero(np.diff(task, prepend=task[0] - 1 if len(task) else 0))
    size = np.diff(np.append(edges, len(task)))
    links = [spanning_links(prints[e : e + n], errors) for e, n in zip(edges[size > FEW], size[size > FEW], strict=True)]
    small = np.repeat((size > 1) & (size <= FEW), size)
    task, prints = task[small], prints[small]
    top = np.arange(len(prints))  # of small runs: a row's earliest known relation
    for step in range(1, min(FEW, len(prints))):
        i = np.flatnonzero(task[step:] == task[:-step])
        i = i[np.bitwise_count(prints[i] ^ prints[i + step]) <= errors]
        new = top[i + step] != top[i]
        top[i + step] = np.minimum(top[i + step], top[i])
        links.append((prints[i[new]], prints[i[new] + step]))
    none = np.zeros(0, arrays.U64)
    return np.concatenate([none, *(x for x, _ in links)]), np.concatenate([none, *(y for _, y in links)])


def near_links(classes: DataFrame, most: int = MOST) -> DataFrame:
    """Links (a, b) that connect the classes (fingerprint) as all links do."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy().view(arrays.U64)
            for at in range(0, len(prints), MOST):
                found, owner = segment_keys(prints[at : at + MOST])
                yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(arrays.signed(prints[at : at + MOST][owner]))], names=["task", "fingerprint"])

    def compared(rows: DataFrame, limit: int | None) -> DataFrame:
        ordered = rows.repartition("task").sortWithinPartitions("task")
        return ordered.mapInArrow(lambda batches: _runs(batches, limit), "task long, a long, b long")

    # keys of more than ``most`` classes come back as they are, to be dealt out
    listed = classes.select("fingerprint").mapInArrow(keys, "task long, fingerprint long")
    found = table(compared(listed, most), "key-links")
    large = found.where("task is not null").select(F.col("task").alias("key"), F.col("a").alias("fingerprint"))
    blocks = large.groupBy("key").agg(F.ceil(F.count("*") / most).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.least(own, j) * F.col("blocks") + F.greatest(own, j))
    dealt = large.join(blocks, "key").select("key", "fingerprint", F.explode(pairs).alias("pair"))
    dealt = dealt.select((F.col("key") * (1 << 32) + F.col("pair")).alias("task"), "fingerprint")
    return found.where("task is null").union(compared(dealt, None)).select("a", "b").distinct()


def _runs(batches: Iterator[pa.RecordBatch], limit: int | None) -> Iterator[pa.RecordBatch]:
    """(null, a, b): spanning links of each run of equal tasks in rows (task,
    fingerprint); the rows of longer runs than ``limit`` as (task, fingerprint, null)."""
    no_task, no_prints = np.zeros(0, np.int64), np.zeros(0, arrays.U64)
    task, prints, passing = no_task, no_prints, None

    def rows(task: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        n = max(len(task), len(a))
        columns = [pa.array(x) if len(x) else pa.nulls(n, pa.int64()) for x in (task, arrays.signed(a), arrays.signed(b))]
        return pa.RecordBatch.from_arrays(columns, names=["task", "a", "b"])

    def ended(task: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        long = np.zeros(len(task), bool)
        if limit is not None and len(task):
            start = np.flatnonzero(np.diff(task, prepend=task[0] - 1))
            size = np.diff(np.append(start, len(task)))
            long = np.repeat(size > limit, size) | (task == passing)
        yield rows(task[long], prints[long], no_prints)
        yield rows(no_task, *group_links(task[~long], prints[~long]))

    for batch in batches:
        task = np.concatenate([task, batch.column(0).to_numpy()])
        prints = np.concatenate([prints, batch.column(1).to_numpy().view(arrays.U64)])
        done = int(np.searchsorted(task, task[-1])) if len(task) else 0  # the last run may go on
        yield from ended(task[:done], prints[:done])
        task, prints = task[done:], prints[done:]
        if limit is not None and len(task) > limit:
            passing = task[0]
            yield rows(task, prints, no_prints)
            task, prints = no_task, no_prints
    yield from ended(task, prints)


def simhash_dedup(docs: DataFrame, *, width: int = 4, most: int = MOST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits) and component_id, the
    smallest id that links reach from it."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.slices(batch, "text"):
                prints = fingerprints(part.column(1), width)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(arrays.signed(prints))], names=["doc_id", "fingerprint"])

    signed = table(rows.mapInArrow(run, "doc_id long, fingerprint long"), "fingerprints")
    classes = table(signed.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "classes")
    found = components(near_links(classes, most))
    members = classes.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint")
    least = members.groupBy("component").agg(F.min("least").alias("component_id"))
    joined = members.join(least, "component").select("fingerprint", "component_id")
    named = classes.join(joined.withColumnRenamed("component_id", "wider"), "fingerprint", "left")
    named = named.select("fingerprint", F.when(F.col("wider").isNull(), F.col("least")).otherwise(F.col("wider")).alias("component_id"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salted = signed.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    joined = salted.join(named.select("*", salts), ["fingerprint", "salt"])
    return joined.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")

