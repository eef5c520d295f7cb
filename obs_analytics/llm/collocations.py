"""Phrase collocation mining (operator 11) with weighted acyclic automata.

Texts are cut into pieces at punctuation and line ends, pieces into words;
everything is counted per language. A candidate is a phrase of two to
``longest`` words that occurs ``least`` times or more, overlaps included. Cut
after its first k words it scores floor(10^6 a^2 / (l r)), a, l and r being the
counts of the phrase and of its two parts; its lowest-scoring cut counts.

1. A Count-min sketch of words and word pairs leaves out what cannot occur
   ``least`` times: a longer phrase occurs no more often than its pairs. A second
   one, of the runs of three words that the first lets through and of the words
   in pairs that it lets through, does so again: no other word is asked for.
2. Each task gathers the phrases of its texts that are left, sorts them, and
   builds count transducers from them run by run, one per range of the prefixes
   (language and first two words, dealt to ranges by hash): minimal acyclic
   automata whose arcs carry the counts (``automata``).
3. The transducers of one range are united from the root on, weights of equal
   paths added; phrases below ``least`` go, the rest is built anew.
4. Every candidate asks for its parts. A part's count lies in the range of its
   own prefix, where the requests stream past that range's transducer and are
   composed with it; the ranges are laid out ``SALTS`` times, so that the many
   requests for one frequent word spread over several tasks.
5. Answers return to their candidates: scores, and the shorter candidates that
   a longer one covers. Each language's first ``top`` are kept by task, then ranked.

Bounds: each of the two bitmaps sent to all tasks has ``2 * cells`` bits whatever
the input; with many more keys than cells a sketch lets more phrases through (up
to one row per phrase and task) and the results stay the same. A range holds
the phrases of about ``RANGE_BYTES`` of text. Words, and the phrases of a task,
are told apart by 64-bit hashes.

Defined results: null, empty and wordless texts count nothing; a null language
is ``und``; ids play no part, and rows that repeat count each; ties are ranked
by phrase; an empty table gives an empty table; further columns are left out.
Counts are exact, and so are scores while 10^6 a^2 stays below 10^38.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obs_analytics.llm import arrays, automata, sketch
from obs_analytics.llm.checkpoints import table

CELLS = 1 << 27
RANGE_BYTES = 16 << 20
HELD = 1 << 19  # distinct phrases that a task gathers before it emits their transducers
SALTS = 4
U64 = arrays.U64

#: Bytes that end a piece, and bytes that end a word within a piece.
PIECE_END = np.zeros(256, bool)
PIECE_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
WORD_END = PIECE_END.copy()
WORD_END[[0x20, 0x09]] = True

def _lang_labels(langs: pa.Array) -> np.ndarray:
    data, offsets = arrays.buffers(pa.compute.binary_join_element_wise(langs, "|", ""))
    return np.maximum(arrays.span_hashes(data, offsets[:-1], offsets[1:], 1), U64(1))


def _packed(langs: list[str], words: list[str]) -> bytes:
    """Strings as their numbers, lengths and bytes, in alphabetical order."""
    found = [x.encode() for x in (*sorted(langs), *sorted(words))]
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    width = np.min_scalar_type(int(lengths.max(initial=0))).itemsize
    return np.array([len(langs), len(words), width], "<i8").tobytes() + lengths.astype(f"<u{width}").tobytes() + b"".join(found)


def _named(packed: pa.Scalar) -> tuple[np.ndarray, pa.Array]:
    """Strings of one row by their labels, which follow from them."""
    packed = packed.as_buffer()
    n_langs, n_words, width = np.frombuffer(packed, "<i8", 3).tolist()
    ends = np.concatenate([[0], np.cumsum(np.frombuffer(packed, f"<u{width}", n_langs + n_words, 24), dtype=np.int64)])
    data = packed[24 + width * (n_langs + n_words) :]
    names = pa.Array.from_buffers(pa.string(), n_langs + n_words, [None, pa.py_buffer(ends.astype(np.int32)), data])
    words = arrays.span_hashes(np.frombuffer(data, np.uint8), ends[n_langs:-1], ends[n_langs + 1 :])
    labels = np.concatenate([_lang_labels(names[:n_langs]), np.maximum(words, U64(1))])
    order = np.argsort(labels)
    return labels[order], names.take(pa.array(order))


class Pieces:
    """Words of one slice of texts with their hashes and pieces."""

    def __init__(self, texts: pa.Array) -> None:
        data, offsets = arrays.buffers(texts)
        self.data = arrays.LOWER[data]
        self.starts, self.ends, self.first = arrays.spans(self.data, offsets, ~WORD_END[self.data])
        self.hashes = np.maximum(arrays.span_hashes(self.data, self.starts, self.ends), U64(1))  # 0 is no word
        before = np.concatenate([[0], np.cumsum(PIECE_END[self.data])])
        new = np.ones(len(self.starts), bool)
        new[1:] = before[self.starts[1:]] > before[self.ends[:-1]]
        new[self.first[:-1][np.diff(self.first) > 0]] = True
        self.piece = np.cumsum(new)

    def runs(self, n: int) -> np.ndarray:
        """Where runs of n words of one piece start."""
        return np.flatnonzero(self.piece[n - 1 :] == self.piece[: len(self.piece) - n + 1])


def _sketch_keys(texts: pa.Array) -> np.ndarray:
    found = Pieces(texts)
    return np.concatenate([found.hashes, arrays.rolling(found.hashes, 2)[found.runs(2)]])


def _at_most(keys: np.ndarray, most: int) -> np.ndarray:
    """Each key so often or less: no count that reaches ``most`` falls below it."""
    found, count = np.unique(keys, return_counts=True)
    return np.repeat(found, np.minimum(count, most))


def _let_through(found: Pieces, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word: whether it, and the pair that starts at it, may occur often enough."""
    often = sketch.reaches(bits, found.hashes)
    pair = np.zeros(len(often), bool)
    at = found.runs(2)
    at = at[often[at] & often[at + 1]]
    pair[at] = sketch.reaches(bits, arrays.rolling(found.hashes, 2)[at])
    return often, pair


def _linked(found: Pieces, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words in pairs that may occur often enough, where runs of three words start
    whose pairs both may, and the keys of those words and runs, joined."""
    words, at = np.flatnonzero(pair | np.append(False, pair[:-1])[: len(pair)]), np.flatnonzero(pair[:-1] & pair[1:])
    return words, at, np.concatenate([arrays.mixed(found.hashes[words]), arrays.rolling(found.hashes, 3)[at]])


def _condensed(keys: np.ndarray, phrases: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of equal keys added up."""
    order = np.argsort(keys)
    keys = keys[order]
    start = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
    return keys[start], phrases[order[start]], np.add.reduceat(counts[order], start) if len(start) else counts


def phrases_of(found: Pieces, langs: np.ndarray, longest: int, bits: np.ndarray, linked_bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, phrases, counts) of one slice: per language its words in all, then
    words and runs of words as far as the sketches let them through. A phrase
    starts with its language (``langs`` per text); its key is its hash."""
    lang = np.repeat(langs, np.diff(found.first))
    often, pair = _let_through(found, bits)
    triple = np.zeros(len(often), bool)
    _, at, _ = _linked(found, pair)
    triple[at] = sketch.reaches(linked_bits, arrays.rolling(found.hashes, 3)[at])
    asked = often.copy()  # wherever it stands, a word counts that is in such a pair anywhere
    asked[often] = sketch.reaches(linked_bits, arrays.mixed(found.hashes[often]))
    total, where = np.unique(langs, return_inverse=True)
    rows = np.zeros((len(total), longest + 1), U64)
    rows[:, 0] = total
    out = [(total, rows, np.bincount(where, np.diff(found.first), len(total)).astype(np.int64))]
    at = np.arange(len(often))
    for n in range(1, longest + 1):
        at = at[at + n - 1 < len(often)]
        kept = at[asked[at] if n == 1 else pair[at] if n == 2 else triple[at + n - 3]]
        at = at if n == 1 else kept  # a longer phrase's pairs and triples are all let through
        keys, one, counts = np.unique(arrays.mixed(lang[kept] + arrays.rolling(found.hashes, n, n)[kept]), return_index=True, return_counts=True)
        rows = np.zeros((len(one), longest + 1), U64)
        rows[:, 0] = lang[kept[one]]
        for j in range(n):
            rows[:, j + 1] = found.hashes[kept[one] + j]
        out.append((keys, rows, counts))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def range_of(phrases: np.ndarray, ranges: int) -> np.ndarray:
    """The range of a phrase's prefix: its language and first two words."""
    key = arrays.mixed(phrases[:, 0] ^ arrays.mixed(phrases[:, 1] ^ arrays.mixed(phrases[:, 2] + U64(1))))
    return ((key >> U64(32)) * U64(ranges) >> U64(32)).astype(np.int64)


def _count(docs: DataFrame, longest: int, least: int, cells: int, ranges: int) -> DataFrame:
    """(range, automaton, names): one count transducer per range, of the
    phrases that occur ``least`` times or more and each language's words in
    all; the names of the languages and words whose phrases it holds."""
    spark, width = docs.sparkSession, longest + 1
    most = min(least, 255)
    counted = lambda keys_of: spark.sparkContext.broadcast(sketch.bitmaps(docs.select("text"), lambda t: _at_most(keys_of(t), most), (most,), cells)[0])
    shared = counted(_sketch_keys)

    def linked_keys(texts: pa.Array) -> np.ndarray:
        found = Pieces(texts)
        return _linked(found, _let_through(found, shared.value)[1])[2]

    linked = counted(linked_keys)

    def shard(phrases: np.ndarray, counts: np.ndarray, names: dict[int, str]) -> Iterator[pa.RecordBatch]:
        phrases, counts = automata.summed(phrases, counts)
        place = range_of(phrases, ranges)
        order = np.argsort(place, kind="stable")
        edges = np.searchsorted(place[order], np.arange(ranges + 1))
        for r in np.flatnonzero(np.diff(edges)):
            own = order[edges[r] : edges[r + 1]]
            yield _row(r, phrases[own], counts[own], names)

    def _row(r: int, phrases: np.ndarray, counts: np.ndarray, names: dict[int, str]) -> pa.RecordBatch:
        made = automata.Builder(width)
        for run in np.split(np.arange(len(phrases)), np.flatnonzero(np.diff(phrases[:, 0])) + 1):
            made.add(phrases[run], counts[run])
        length = (phrases[:, :3] != 0).sum(1)
        langs, words = (np.unique(phrases[length == i + 1, i]) for i in range(2))
        automaton = made.finish().to_bytes(np.concatenate([langs, words]))
        packed = _packed(*([names[x] for x in labels.tolist()] for labels in (langs, words)))
        return pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([automaton], pa.binary()), pa.array([packed], pa.binary())], names=["range", "automaton", "names"])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, names, n = [], {}, 0
        for batch in batches:
            for part in arrays.slices(batch, "text"):
                found = Pieces(part.column(1))
                kinds = part.column(0).dictionary_encode()
                langs = _lang_labels(kinds.dictionary)
                names.update(zip(langs.tolist(), kinds.dictionary.to_pylist(), strict=True))
                keys, phrases, counts = phrases_of(found, langs[kinds.indices.to_numpy()], longest, shared.value, linked.value)
                often = np.unique(phrases[:, 1])
                hashes, at = np.unique(found.hashes, return_index=True)
                at = at[np.isin(hashes, often, assume_unique=True)]
                text = found.data.tobytes()
                for h, a, b in zip(found.hashes[at].tolist(), found.starts[at].tolist(), found.ends[at].tolist(), strict=True):
                    if h not in names:
                        names[h] = text[a:b].decode()
                held.append((keys, phrases, counts))
                n += len(counts)
                if n > 2 * HELD:
                    held = [_condensed(*(np.concatenate(x) for x in zip(*held, strict=True)))]
                    n = len(held[0][0])
                    if n > HELD:
                        yield from shard(*held[0][1:], names)
                        held, names, n = [], {}, 0
        if held:
            yield from shard(*_condensed(*(np.concatenate(x) for x in zip(*held, strict=True)))[1:], names)

    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, names = None, [], {}

        def done() -> pa.RecordBatch:
            phrases, counts = automata.union(parts, width)
            kept = (counts >= least) | (phrases[:, 1] == 0)
            return _row(now, phrases[kept], counts[kept], names)

        for batch in batches:
            for r, automaton, packed in zip(*batch.columns, strict=True):
                if r.as_py() != now:
                    if parts:
                        yield done()
                    now, parts, names = r.as_py(), [], {}
                labels, strings = _named(packed)
                parts.append(automata.Transducer.from_bytes(automaton.as_py(), labels))
                names.update(zip(labels.tolist(), strings.to_pylist(), strict=True))
        if parts:
            yield done()

    schema = "range int, automaton binary, names binary"
    rows = docs.select("lang", "text").mapInArrow(shards, schema)
    return table(rows.repartition("range").sortWithinPartitions("range").mapInArrow(united, schema), "phrase-counts")


def _decoded(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]]:
    """Phrases, counts, labels and names of each row."""
    for automaton, packed in zip(*batch.columns, strict=True):
        labels, names = _named(packed)
        yield *automata.union([automata.Transducer.from_bytes(automaton.as_py(), labels)], width), labels, names


def _answers(counted: DataFrame, longest: int, cover: int, ranges: int) -> DataFrame:
    """A row for each part of each candidate: (lang, phrase, words, a, start,
    length, count, name) and, where the candidate covers the part, ``covered``.
    Phrases are binary (8 bytes a label, the language first)."""
    width = longest + 1
    packed = lambda phrases: arrays.binaries(np.ascontiguousarray(phrases).tobytes(), np.full(len(phrases), 8 * width))
    fields = ["lang", "phrase", "words", "a", "start", "length"]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for phrases, counts, _, _ in _decoded(batch, width):
                for words in range(2, longest + 1):
                    own = (phrases != 0).sum(1) == words + 1
                    chosen, a = phrases[own], counts[own]
                    salt = (chosen.sum(1) % U64(SALTS)).astype(np.int64)
                    for length in range(1, words):
                        for start in range(words - length + 1):
                            part = np.zeros_like(chosen)
                            part[:, 0], part[:, 1 : length + 1] = chosen[:, 0], chosen[:, start + 1 : start + length + 1]
                            same = lambda x: pa.array(np.full(len(a), x, np.int32))
                            yield pa.RecordBatch.from_arrays(
                                [pa.array((range_of(part, ranges) * SALTS + salt) * 2 + 1), pa.array(arrays.signed(chosen[:, 0].copy())), packed(chosen), same(words), pa.array(a), same(start), same(length)],
                                names=["place", *fields],
                            )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, automaton, labels, names = None, None, np.zeros(0, U64), None
        for batch in batches:
            key = batch.column(0).to_numpy() // 2
            holds = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.concatenate([[True], holds[1:] | (key[1:] != key[:-1])])) if len(key) else []
            for a, b in zip(edges, [*edges[1:], len(key)], strict=False):
                if holds[a]:
                    labels, names = _named(batch.column(2)[a])
                    now, automaton = key[a], automata.Transducer.from_bytes(batch.column(1)[a].as_py(), labels)
                    a += 1
                if a < b:
                    if key[a] != now:
                        raise ValueError(f"no counts for range {key[a] // SALTS}")
                    yield from found(batch.slice(a, b - a), automaton, labels, names)

    def found(rows: pa.RecordBatch, automaton: automata.Transducer, labels: np.ndarray, names: pa.Array) -> Iterator[pa.RecordBatch]:
        own = {name: rows.column(i + 3) for i, name in enumerate(fields)}
        phrases = np.frombuffer(b"".join(own["phrase"].to_pylist()), U64).reshape(-1, width)
        a, start, length = (own[c].to_numpy() for c in ("a", "start", "length"))
        part = np.zeros_like(phrases)
        part[:, 0] = phrases[:, 0]
        for j in range(longest):
            inside = j < length
            part[inside, j + 1] = phrases[inside, start[inside] + 1 + j]
        count = automaton.compose(part)
        place = np.minimum(np.searchsorted(labels, part[:, 1]), max(len(labels) - 1, 0))
        one = pa.array(length != 1)
        named = names.take(pa.array(np.where(length == 1, place, 0))) if len(names) else pa.nulls(len(part), pa.string())
        covers = (length > 1) & (100 * a >= cover * count)
        yield pa.RecordBatch.from_arrays(
            [*own.values(), pa.array(count), pa.compute.if_else(one, pa.scalar(None, pa.string()), named), pa.compute.if_else(pa.array(covers), packed(part), pa.scalar(None, pa.binary()))],
            names=[*fields, "count", "name", "covered"],
        )

    columns = "lang long, phrase binary, words int, a long, start int, length int"
    asked = counted.select("automaton", "names").mapInArrow(ask, f"place long, {columns}")
    nulls = lambda *names: [F.lit(None).alias(n) for n in names]
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    laid_out = counted.select("range", salts, "automaton", "names").select(
        ((F.col("range").cast("long") * SALTS + F.col("salt")) * 2).alias("place"), "automaton", "names", *nulls(*fields))
    both = laid_out.unionByName(asked.select("place", *nulls("automaton", "names"), *fields))
    # one number is sorted by its bits: a transducer (even) before the requests (odd) of its range and salt
    ordered = both.repartition(F.shiftright("place", 1)).sortWithinPartitions("place")
    return table(ordered.mapInArrow(answer, f"{columns}, count long, name string, covered binary"), "phrase-parts")


def collocations(
    docs: DataFrame, *, longest: int = 3, least: int = 10, cover: int = 50, top: int = 2000, cells: int = CELLS, ranges: int | None = None,
    lang_col: str = "lang", text_col: str = "text",
) -> DataFrame:
    """Per language its first ``top`` candidates that no longer one covers (holds
    them and occurs at least ``cover`` per cent as often): lang, rank, phrase, a,
    l, r, n (the language's words in all) and score, by descending score, then
    descending a, then phrase. ``ranges`` is by default one per RANGE_BYTES of text."""
    rows = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"), docs[text_col].alias("text"))
    if ranges is None:
        ranges = max(8, (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // RANGE_BYTES)
    counted = _count(rows, longest, least, cells, ranges)
    answers = _answers(counted, longest, cover, ranges)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for phrases, counts, labels, names in _decoded(batch, longest + 1):
                own = phrases[:, 1] == 0
                at = np.searchsorted(labels, phrases[own, 0])
                yield pa.RecordBatch.from_arrays([pa.array(arrays.signed(phrases[own, 0])), names.take(pa.array(at)), pa.array(counts[own])], names=["label", "lang", "n"])

    langs = counted.select("automaton", "names").mapInArrow(totals, "label long, lang string, n long")
    at = lambda start, length, value: F.max(F.when((F.col("start") == start) & (F.col("length") == length), F.col(value)))
    cuts = range(1, longest)
    parts = answers.groupBy("lang", "phrase", "words", "a").agg(
        *(at(0, k, "count").alias(f"l{k}") for k in cuts), *(at(k, F.col("words") - k, "count").alias(f"r{k}") for k in cuts),
        *(at(i, 1, "name").alias(f"w{i}") for i in range(longest)),
    )
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    score = lambda k: F.call_function("div", wide("a") * wide("a") * F.lit(1_000_000).cast("decimal(7,0)"), wide(f"l{k}") * wide(f"r{k}"))
    cut = lambda k: F.when(F.col("words") > k, F.struct(score(k).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    scored = parts.select("lang", "phrase", "a", F.array_min(F.array(*(cut(k) for k in cuts))).alias("cut"), F.concat_ws(" ", *(f"w{i}" for i in range(longest))).alias("text"))
    covered = answers.where("covered is not null").select(F.col("covered").alias("phrase")).distinct()
    left = scored.join(covered, "phrase", "left_anti").select("lang", "text", "a", "cut.l", "cut.r", "cut.score")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "text"))
    first = left.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top).withColumnRenamed("lang", "label")
    return first.join(langs, "label").select("lang", "rank", F.col("text").alias("phrase"), "a", "l", "r", "n", "score")
