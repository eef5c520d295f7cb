"""BPE of the ``tokenizers`` library over Arrow batches (used by op4 and op7).

A text is cut before each ASCII whitespace run that follows other text; no
match of the supported split patterns crosses such a cut, so the ids of a text
are the ids of its chunks, joined. Each distinct chunk of a batch is looked up
in a bounded per-worker cache; chunks of plain Latin letters, digits and
punctuation are split here and merged by the library's model, all others go
through the library's whole normaliser / pre-tokenizer / model chain. Word-end
BPE drops whitespace, so there the pieces themselves are cut out of the bytes and
each distinct one is looked up once.
"""

from __future__ import annotations

import base64
import os
import re
from array import array
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from obs_analytics.llm import arrays

#: Text per slice: more than elsewhere, so that more words of a slice repeat.
SLICE_BYTES = 4 << 20
#: Bounds on the entries of each per-worker cache (about 250 bytes each); a
#: full cache starts anew. Word-end BPE saves more per entry.
RANK_CACHE, WORD_CACHE = 150_000, 600_000
_LETTER, _MARK = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-/:-;=-@\[-`{-~"  # without ' (contractions) and < (special tokens)


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies:
    printable Latin-1 stands for itself, the others follow from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file in rank order."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * (1 + max(int(rank) for _, rank in pairs))
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def tokenizer_from_ranks(path: str, pattern: str):
    """A ``tokenizers`` BPE that merges by the ranks of a file: every split of a
    token into two tokens of lower rank is a merge, in rank order, and a match
    that is a token by itself is that token."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    chars, tokens = byte_characters(), read_ranks(path)
    rank = {token: i for i, token in enumerate(tokens) if token}
    text = {token: "".join(chars[b] for b in token) for token in rank}
    merges = []
    for token, i in rank.items():
        for at in range(1, len(token)):
            left, right = token[:at], token[at:]
            if rank.get(left, i) < i and rank.get(right, i) < i:
                merges.append((text[left], text[right]))
    made = Tokenizer(models.BPE(vocab={text[t]: i for t, i in rank.items()}, merges=merges, ignore_merges=True))
    made.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
    ])
    return made


@dataclass
class ChunkEncoder:
    """Ids of texts, chunk by chunk. ``pieces`` splits a plain chunk as the
    tokenizer's own pattern does; ``lower`` lower-cases them first."""

    tokenizer: object
    plain: re.Pattern
    pieces: re.Pattern
    lower: bool
    entries: int
    chunk_ids: dict[str, bytes] = field(default_factory=dict)
    piece_ids: dict[str, bytes] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.as_chars = {b: c for b, c in enumerate(byte_characters()) if b < 0x80}
        chars = byte_characters()
        self.as_chars |= {c: "".join(chars[b] for b in chr(c).encode()) for c in range(0x80, 0x100)}
        self.model = self.tokenizer.model

    def _piece(self, piece: str) -> bytes:
        if len(self.piece_ids) >= self.entries:
            self.piece_ids.clear()
        ids = [t.id for t in self.model.tokenize(piece.translate(self.as_chars))]
        found = self.piece_ids[piece] = array("I", ids).tobytes()
        return found

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        out: list[bytes | None] = list(map(self.chunk_ids.get, chunks))
        odd, known, plain, pieces = [], self.piece_ids.get, self.plain.fullmatch, self.pieces.findall
        for i in [i for i, ids in enumerate(out) if ids is None]:
            chunk = chunks[i]
            if plain(chunk):
                parts = pieces(chunk.lower() if self.lower else chunk)
                ids = known(parts[0]) if len(parts) == 1 else None
                out[i] = ids if ids is not None else b"".join([self._piece(p) if (x := known(p)) is None else x for p in parts])
            else:
                odd.append(i)
        if odd:
            for i, made in zip(odd, self.tokenizer.encode_batch_fast([chunks[i] for i in odd], add_special_tokens=False), strict=True):
                out[i] = array("I", made.ids).tobytes()
        if len(self.chunk_ids) + len(chunks) > self.entries:
            self.chunk_ids.clear()
        self.chunk_ids.update(zip(chunks[: self.entries], out))
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts joined, number of ids of each text)."""
        data, offsets = arrays.buffers(texts)
        if len(data) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        starts = chunk_starts(data, offsets)
        bounds = np.append(starts, len(data)).astype(np.int32)
        chunks = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))).dictionary_encode()
        return _joined(self._chunks(chunks.dictionary.to_pylist()), chunks.indices.to_numpy(zero_copy_only=False), starts, offsets)


#: Kinds of the bytes of plain chunks; 0 is in no plain chunk.
LETTERS, DIGITS, MARKS, SPACES, ODD = range(1, 6)
KIND = np.zeros(256, np.uint8)
KIND[[i for i in range(0x80) if re.match(r"[A-Za-z]", chr(i))]] = LETTERS
KIND[[i for i in range(0x80) if re.match(rf"[{_MARK}]", chr(i))]] = MARKS
KIND[0x30:0x3A], KIND[arrays.SPACE] = DIGITS, SPACES


@dataclass
class PieceEncoder(ChunkEncoder):
    """Where whitespace has no ids: plain chunks are cut into pieces, lower-cased,
    as byte spans of the whole slice; each distinct piece, and each distinct other
    chunk, is looked up once."""

    def _items(self, items: list[str]) -> list[bytes]:
        out: list[bytes | None] = list(map(self.piece_ids.get, items))
        odd, plain = [], self.pieces.fullmatch
        for i in [i for i, ids in enumerate(out) if ids is None]:
            if plain(items[i]):
                out[i] = self._piece(items[i])
            else:
                odd.append(i)
        if odd:
            for i, made in zip(odd, self.tokenizer.encode_batch_fast([items[i] for i in odd], add_special_tokens=False), strict=True):
                if len(self.piece_ids) >= self.entries:
                    self.piece_ids.clear()
                out[i] = self.piece_ids[items[i]] = array("I", made.ids).tobytes()
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = arrays.buffers(texts)
        if len(data) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        chunks = chunk_starts(data, offsets)
        kind, lowered = KIND[data], arrays.LOWER[data]
        at = np.flatnonzero(data[:-1] == 0xC3)  # U+00C0 to U+00FF, two signs among them
        second = data[at + 1]
        at, second = at[(second != 0x97) & (second != 0xB7)], second[(second != 0x97) & (second != 0xB7)]
        kind[at] = kind[at + 1] = LETTERS
        lowered[at + 1] += np.where(second < 0x9F, 0x20, 0).astype(np.uint8)
        plain = np.repeat(np.minimum.reduceat(kind, chunks) > 0, np.diff(np.append(chunks, len(data))))
        kind[~plain] = ODD
        cut = kind == DIGITS
        cut[1:] |= kind[1:] != kind[:-1]
        cut[chunks] = True
        starts, kept = np.flatnonzero(cut), kind != SPACES
        starts = starts[kept[starts]]
        if len(starts) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        spans = np.where(plain, lowered, data)[kept]
        bounds = np.append((np.cumsum(kept, dtype=np.int32) - 1)[starts], len(spans)).astype(np.int32)
        items = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(spans)).dictionary_encode()
        return _joined(self._items(items.dictionary.to_pylist()), items.indices.to_numpy(zero_copy_only=False), starts, offsets)


def _joined(coded: list[bytes], which: np.ndarray, starts: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all spans, that start at ``starts``, and their number in each text."""
    flat = np.frombuffer(b"".join(coded), np.uint32)
    size = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
    counts = size[which]
    ids = flat[np.repeat((np.cumsum(size) - size)[which], counts) + arrays.ramp(counts)]
    ends = np.concatenate([[0], np.cumsum(counts)])
    return ids, np.diff(ends[np.searchsorted(starts, offsets)])


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks begin: at each text, and at ASCII whitespace after a byte
    that is neither whitespace nor part of a wider (Unicode) space."""
    space = arrays.SPACE[data]
    glue = space | ((data >= 0x1C) & (data <= 0x1F))
    for lead, length, last in (
        (0xC2, 2, {0x85, 0xA0}), (0xE1, 3, {0x80}), (0xE2, 3, {*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF, 0x9F}), (0xE3, 3, {0x80}),
    ):
        at = np.flatnonzero(data == lead)
        at = at[at + length <= len(data)]
        glue[at[np.isin(data[at + length - 1], list(last))] + length - 1] = True
    cut = space.copy()
    cut[1:] &= ~glue[:-1]
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(cut)


_ENCODERS: dict[tuple, ChunkEncoder] = {}


def rank_encoder(path: str, pattern: str) -> ChunkEncoder:
    """Encoder by the ranks of a file; one per worker process."""
    key = ("ranks", path, pattern)
    if key not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[key] = ChunkEncoder(
            tokenizer_from_ranks(path, pattern),
            re.compile(rf"[ \n]?[{_LETTER}0-9{_MARK}]+"),
            re.compile(rf" ?[{_LETTER}]+| ?[0-9]+| ?[{_MARK}]+|\n"),
            lower=False,
            entries=RANK_CACHE,
        )
    return _ENCODERS[key]


def word_encoder(path: str) -> PieceEncoder:
    """Encoder of a lower-casing word-end BPE file that drops whitespace; one
    per worker process."""
    key = ("words", path)
    if key not in _ENCODERS:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[key] = PieceEncoder(
            Tokenizer.from_file(path),
            re.compile(rf"[ \t\n\r\f\v]*[{_LETTER}0-9{_MARK}]+"),
            re.compile(rf"[{_LETTER}]+|[0-9]|[{_MARK}]+"),
            lower=True,
            entries=WORD_CACHE,
        )
    return _ENCODERS[key]
