"""N-gram Jaccard join (operator 6): links of near-equal documents.

Two documents link when 100 * intersection >= threshold * union of their sets
of word shingles. Documents with equal sets are one class, compared once.

1. Sets that link differ in at most ``d = n (100 - percent) / percent`` shingles,
   n being the smaller size. Shingles are dealt by hash into a few more than d
   parts (d for the largest n of the size class), so two sets that link agree in
   some parts; a key is the hash of one part. Empty parts make no key unless a
   set has so many that a link might rest on them alone. A document
   makes keys for its own size class and, as the larger of a pair, for the class
   below. One exchange by key tells how many rows hold each, so the rows moved are
   the keys, in proportion to the text. Of a document's keys for a class all go
   unless as many recur as the parts that a linked set must share: a passage
   common to two texts fills few parts. Of those left only the rarest are
   compared, all but one less than must be shared: two sets that share so many
   keys share one of these.
2. Classes that share a key, directly or through others, are a cluster
   (connected components). A part has about ``percent / (100 - percent)``
   shingles, so a shared passage alone seldom makes a key recur. A bitmap of the
   clusters' members picks the texts whose sets are built again, so no set is
   stored or moved in vain.
3. Per cluster, the product of the document by n-gram incidence matrix with
   its transpose is taken in blocks of rows and columns; overlap counts
   accumulate over column blocks, and pairs below the bound that their sizes
   set are dropped. A large cluster is dealt out as pairs of row blocks, only
   between size classes that can link. A task keeps a spanning forest of the
   links that it finds, never a list of all pairs.
4. Components of the links, taken back to the classes' members.

Defined results: null, empty and wordless texts have the empty set and link
with nothing; ties (equal sets) are one class; rows that share an id are one
node, linked by any of their texts; rows without an id are one node per text (a
negative number from its 64-bit hash), so they bridge groups only by links of
that text, and get a null component unless their group has an id; an empty table gives an empty table; further columns
are left out. Shingles are told apart by 64-bit hashes, classes by 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obs_analytics.llm import arrays, sketch
from obs_analytics.llm.checkpoints import drop, table
from obs_analytics.llm.graph import components

NAMELESS = -(1 << 63)  # bit of the nodes of rows without an id
ROWS, COLUMNS = 512, 1 << 13
CELLS = 1 << 26  # the bitmap of cluster members that goes to all tasks is 16 MB


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, set number of each): distinct shingles by text, sorted by both.
    ASCII letters are lower-cased; fewer words than ``width`` are one shingle."""
    data, offsets = arrays.buffers(texts)
    data = arrays.LOWER[data]
    starts, ends, first = arrays.spans(data, offsets, arrays.SPACE[data] == 0)
    words = arrays.span_hashes(data, starts, ends)
    at = arrays.window_starts(first, width)
    doc, found = [np.searchsorted(first, at, "right") - 1], [arrays.rolling(words, width)[at]]
    for n in range(1, width):
        own = np.flatnonzero(np.diff(first) == n)
        doc.append(own)
        found.append(arrays.rolling(words, n, n)[first[own]])
    owner, hashes = arrays.unique_pairs(np.concatenate(doc), np.concatenate(found))
    return hashes, owner


def size_class(n: np.ndarray, percent: int) -> np.ndarray:
    """Sizes that can link are in equal or neighbouring classes."""
    return np.floor(np.log(n) / np.log(100 / percent) + 1e-9).astype(np.int64)


def part_keys(hashes: np.ndarray, owner: np.ndarray, count: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, set number, below, need) of the parts of ``count`` sets (hashes by
    owner), for each set's own size class (below 0) and the class below (1). A
    set that links with one of that class shares at least ``need`` of these keys
    with it: the parts, less those that may differ and those that make no key."""
    size = np.bincount(owner, minlength=count)
    own = size_class(np.maximum(size, 1), percent)
    found = []
    for below in (0, 1):
        group = own - below
        largest = np.ceil((100 / percent) ** (group + 1)).astype(np.int64)
        differ = largest * (100 - percent) // percent
        m = np.where(differ > 0, differ + 2 + differ // 8, 1)
        part = (arrays.mixed(hashes ^ arrays.U64(0x5DEECE66D)) >> arrays.U64(33)).astype(np.int64) * m[owner] >> 31
        order = np.argsort(owner * (int(m.max(initial=1)) + 1) + part)
        o, p, h = owner[order], part[order], hashes[order]
        first = np.flatnonzero(np.concatenate([[True], (o[1:] != o[:-1]) | (p[1:] != p[:-1])])) if len(o) else np.zeros(0, np.int64)
        sums = np.add.reduceat(arrays.mixed(h), first) if len(o) else np.zeros(0, arrays.U64)
        o, p = o[first], p[first]
        # a pair's equal parts may all be empty only where so many parts are
        empty = m - np.bincount(o, minlength=count)
        keyed = (size > 0) & (empty >= m - differ) & (m > 1)
        need = np.maximum(m - differ - np.where(keyed, 0, empty), 1)
        for i in np.flatnonzero(keyed):
            missing = np.setdiff1d(np.arange(m[i]), p[o == i])
            o, p, sums = np.append(o, np.full(len(missing), i)), np.append(p, missing), np.append(sums, np.zeros(len(missing), arrays.U64))
        salt = (group[o] * (1 << 32) + p).astype(np.int64).view(arrays.U64)
        keep = m[o] > 1  # one part is the whole set: only equal sets link
        o = o[keep]
        found.append((arrays.mixed(sums ^ arrays.mixed(salt))[keep], o, np.full(len(o), below), need[o]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what all the given links connect, none to spare."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = top(x), top(y)
        if p != q:
            up[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def overlaps(sets: list[np.ndarray], columns: int = COLUMNS) -> np.ndarray:
    """Overlap counts of all pairs of the sets: the incidence matrix times its
    transpose, summed over blocks of columns."""
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    row = np.repeat(np.arange(len(sets)), size)
    grams, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(seen > 1) - 1
    keep = seen[column] > 1
    row, column = row[keep], shared[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    edges = np.searchsorted(column, np.arange(0, len(grams) + columns, columns))
    for k in range(len(edges) - 1):
        here = slice(edges[k], edges[k + 1])
        if edges[k] < edges[k + 1]:
            block = np.zeros((len(sets), columns), np.float32)
            block[row[here], column[here] - k * columns] = 1
            total += block @ block.T
    return total.astype(np.int64)


def links_in(ids: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Spanning links of one block (all sides equal) or pair of blocks."""
    n = np.fromiter(map(len, sets), np.int64, len(sets))
    both = overlaps(sets)
    i, j = np.nonzero(np.triu(both, 1))
    ok = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
    if sides.min() != sides.max():
        ok &= sides[i] != sides[j]
    i, j = i[ok], j[ok]
    meet = both[i, j]
    ok = 100 * meet >= percent * (n[i] + n[j] - meet)
    return _forest(ids[i[ok]], ids[j[ok]])


def jaccard_join(docs: DataFrame, *, width: int = 3, percent: int = 90, cells: int = CELLS, id_col: str = "doc_id", text_col: str = "text", keyed: bool = False) -> DataFrame:
    """Per document: doc_id, n_shingles and component_id, the smallest id that
    links reach from it; with ``keyed`` also text_key, the xxhash64 of its text,
    and leads, whether it is the document that its group is named after (in a
    group without ids, the one text that stands for it)."""
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    rows = rows.select(F.coalesce("id", F.xxhash64("text").bitwiseOR(F.lit(NAMELESS))).alias("node"), "text", "id", F.xxhash64("text").alias("text_key"))

    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.slices(batch, "text"):
                hashes, owner = shingle_sets(part.column(1), width)
                ends = np.searchsorted(owner, np.arange(part.num_rows + 1))
                data = memoryview(hashes.astype("<u8")).cast("B")
                marks = [hashlib.blake2b(data[8 * a : 8 * b], digest_size=16).digest() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                mark = np.frombuffer(b"".join(marks), np.int64).reshape(-1, 2)
                keys, holder, below, need = part_keys(hashes, owner, part.num_rows, percent)
                needs = np.ones(2 * part.num_rows, np.int32)
                needs[2 * holder + below] = need
                lists = []
                for b in (0, 1):
                    own = np.flatnonzero(below == b)
                    own = own[np.argsort(holder[own], kind="stable")]
                    lists += [arrays.list_array(pa.array(arrays.signed(keys[own])), np.bincount(holder[own], minlength=part.num_rows)), pa.array(needs[b::2])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), part.column(3), pa.array(np.diff(ends)), pa.array(mark[:, 0]), pa.array(mark[:, 1]), *lists],
                    names=["node", "id", "text_key", "n", "mark1", "mark2", "keys0", "need0", "keys1", "need1"],
                )

    signed = table(rows.mapInArrow(signatures, "node long, id long, text_key long, n long, mark1 long, mark2 long, keys0 array<long>, need0 int, keys1 array<long>, need1 int"), "signatures")
    own = table(signed.select("node", "id", "text_key", "n", "mark1", "mark2"), "sets")
    classes = own.where("n > 0").groupBy("mark1", "mark2").agg(F.min("id").alias("least"), F.min("node").alias("first"), F.count("*").alias("copies"))
    # stored, so that its size is known before the keys are joined with it
    copied = table(classes.where("copies > 1").select("mark1", "mark2", F.coalesce("least", "first").alias("first"), "least"), "copied")
    kinds = [F.struct(F.lit(b).alias("below"), F.col(f"need{b}").alias("need"), F.col(f"keys{b}").alias("keys")) for b in (0, 1)]
    asked = signed.where("size(keys0) > 0 or size(keys1) > 0").select("node", "mark1", "mark2", F.array(*kinds).alias("kinds"))
    firsts = asked.join(copied, ["mark1", "mark2"], "left").where("first is null or first = node")
    listed = firsts.select("node", F.inline("kinds")).select("node", "below", "need", F.explode("keys").alias("key"))
    clusters = components(key_links(rarest_keys(listed)))
    drop(signed)  # its keys are the bulk of what this operator stores
    linked = own.join(copied, ["mark1", "mark2"], "left")
    linked = linked.select("node", "id", "text_key", "n", F.when(F.col("n") > 0, F.coalesce("first", "node")).otherwise(F.col("node")).alias("first"), F.coalesce("least", "id").alias("least"))
    # rows that share an id but not their text tie their classes together
    several = own.groupBy("node").agg(F.min("mark1").alias("low"), F.max("mark1").alias("high")).where("low <> high").select("node")
    tied = linked.join(several, "node", "left_semi").select(F.col("node").alias("a"), F.col("first").alias("b"))
    texts = rows.where("id is not null").union(rows.where("id is null").dropDuplicates(["node"])).select("node", "text")
    found = block_links(member_sets(texts, clusters, width, min(cells, CELLS)), clusters, own.where("n > 0").select("node", "n"), percent)
    links = components(found.union(tied))
    nameless = own.where("id is null").select("node", F.lit(True).alias("nameless")).distinct()
    least = links.join(nameless, "node", "left").groupBy("component").agg(F.min(F.when(F.col("nameless").isNull(), F.col("node"))).alias("least_id"))
    links = links.join(least, "component").select(F.col("node").alias("member"), "least_id", F.coalesce("least_id", "component").alias("leader"))

    result = linked.join(links, linked["first"] == links["member"], "left")
    return result.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("member").isNull(), F.col("least")).otherwise(F.col("least_id")).alias("component_id"),
        *([F.col("text_key"), (F.col("node") == F.coalesce("leader", "first")).alias("leads")] if keyed else []),
    )


def rarest_keys(listed: DataFrame) -> DataFrame:
    """(node, key) of the keys (node, below, need, key) that must be compared.
    Keys are ordered by the number of rows that hold them, then by value; a node
    keeps all but its last need - 1, and none where it has fewer than ``need``
    that others hold too. Two nodes that share ``need`` keys share the first of
    them among those kept. Rows of one node are taken together, which keeps more."""
    held = listed.withColumn("held", F.count("*").over(Window.partitionBy("key"))).where("held > 1")
    ranked = held.groupBy("node", "below").agg(F.min("need").alias("need"), F.sort_array(F.collect_list(F.struct("held", "key"))).alias("keys"))
    kept = ranked.where(F.size("keys") >= F.col("need")).select("node", F.explode(F.slice("keys", F.lit(1), F.size("keys") - F.col("need") + 1)).alias("kept"))
    return kept.select("node", F.col("kept.key").alias("key"))


def key_links(keys: DataFrame) -> DataFrame:
    """Links (a, b) of each node with the smallest that shares a key (node, key)."""
    hub = F.min("node").over(Window.partitionBy("key"))  # one exchange; a large group spills
    return keys.select(F.col("node").alias("a"), hub.alias("b"))


def member_sets(rows: DataFrame, clusters: DataFrame, width: int, cells: int) -> DataFrame:
    """(node, shingles) of the rows (node, text) that are in a cluster; a few
    others may slip through the bitmap and are left to the join."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(sketch.bitmaps(clusters.select("node"), lambda ids: ids.to_numpy().view(arrays.U64), (1,), cells)[0])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            member = sketch.reaches(shared.value, batch.column(0).to_numpy().view(arrays.U64))
            for part in arrays.slices(batch.filter(pa.array(member)), "text"):
                hashes, owner = shingle_sets(part.column(1), width)
                size = np.bincount(owner, minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column(0), arrays.binaries(hashes.astype("<u8").tobytes(), 8 * size)], names=["node", "shingles"])

    return rows.mapInArrow(sets, "node long, shingles binary")


def block_links(sets: DataFrame, clusters: DataFrame, sizes: DataFrame, percent: int, most: int = ROWS) -> DataFrame:
    """Links (a, b) within clusters (node, component) of sets (node, shingles)
    with known sizes (node, n). A cluster of up to ``most`` classes is one
    block; a larger one is cut by size class and hash into blocks of about so
    many, and each pair of blocks that can hold links is one task."""
    step = float(np.log(100 / percent))
    placed = clusters.join(sizes.groupBy("node").agg(F.max("n").alias("n"), F.min("n").alias("least")), "node")
    placed = placed.select("component", "node", F.explode(F.sequence(F.floor(F.log("least") / step).cast("int"), F.floor(F.log("n") / step).cast("int"))).alias("q"))
    cells = placed.groupBy("component", "q").agg(F.count("*").alias("held"))
    large = cells.groupBy("component").agg(F.sum("held").alias("total"), F.map_from_entries(F.collect_list(F.struct("q", F.ceil(F.col("held") / most).cast("int")))).alias("blocks")).where(F.col("total") > most)
    dealt = placed.join(large.select("component", "blocks"), "component", "left")
    n_blocks = lambda q: F.coalesce(F.try_element_at("blocks", q), F.lit(0))
    own = F.pmod(F.xxhash64("node"), n_blocks(F.col("q"))).cast("int")
    unit = lambda q1, i, q2, j, side: F.struct(q1.alias("q1"), i.alias("i"), q2.alias("q2"), j.alias("j"), F.lit(side).alias("side"))
    q, one = F.col("q"), F.lit(0)
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    units = F.concat(
        F.transform(upto(n_blocks(q)), lambda j: F.struct(q.alias("q1"), F.least(own, j).alias("i"), q.alias("q2"), F.greatest(own, j).alias("j"), F.when(own <= j, 0).otherwise(1).alias("side"))),
        F.transform(upto(n_blocks(q + 1)), lambda j: unit(q, own, q + 1, j, 0)),
        F.transform(upto(n_blocks(q - 1)), lambda j: unit(q - 1, j, q, own, 1)),
    )
    tasks = dealt.select("component", "node", F.explode(F.when(F.col("blocks").isNull(), F.array(unit(one, one, one, one, 0))).otherwise(units)).alias("unit"))
    tasks = tasks.select(F.xxhash64("component", "unit.q1", "unit.i", "unit.q2", "unit.j").alias("task"), "unit.side", "node").distinct()
    tasks = tasks.join(sets, "node").select("task", "side", "node", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, out = None, [], []

        def finish() -> None:
            if len(rows) > 1:
                ids, sides, sets = (list(x) for x in zip(*rows, strict=True))
                out.extend(links_in(np.array(ids), np.array(sides), [np.frombuffer(s, "<u8") for s in sets], percent))

        def flush() -> pa.RecordBatch:
            made = np.array(out, np.int64).reshape(-1, 2)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(made[:, 0]), pa.array(made[:, 1])], names=["a", "b"])

        for batch in batches:
            for task, side, node, shingles in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if task != now:
                    finish()
                    now, rows = task, []
                rows.append((node, side, shingles))
            yield flush()
        finish()
        yield flush()

    return tasks.repartition("task").sortWithinPartitions("task").mapInArrow(run, "a long, b long")
