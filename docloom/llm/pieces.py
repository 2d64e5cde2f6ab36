"""Encoding texts into vocabulary pieces by batched Viterbi search, and decoding them again.

A text is read as words: a run of blanks with what follows it, up to the next blank. No
piece of the vocabulary reaches across such a border (this is checked when it is loaded), so the
best pieces of a text are those of its words. All new words of a slice of texts are
searched together: words of equal length advance one character at a time, the hashes of all
substrings that end there probe the sorted keys of the pieces, and the best way to
reach each place is a maximum over one axis.

Pieces and scores are those of a SentencePiece model file; the segmentation is the one of
greatest total score. A character without a piece becomes the pieces of its UTF-8 bytes. A
literal word mark is encoded as bytes as well, so decoding returns every text exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: What an unknown character costs below the lowest piece score.
UNKNOWN_COST = 10.0
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LITERAL_MARK = 0x110001  # code of a literal mark; no piece has it
SLICE_CHARS = 2_000_000
CACHED_WORDS = 200_000
WORDS = re.compile(r" *[^ ]+| +")


def _mixed(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)


@dataclass
class Vocabulary:
    """Pieces as sorted hash keys with ids and scores, the ids of single bytes, and each id's bytes."""

    keys: np.ndarray
    ids: np.ndarray
    scores: np.ndarray
    byte_ids: np.ndarray
    bodies: list[bytes]
    longest: int
    unknown_score: float

    def __post_init__(self) -> None:
        # Where the keys with some leading bits begin, so that a probe looks at a few neighbours only.
        self.starts = np.searchsorted(self.keys, np.arange(1 << 18, dtype=np.uint64) << np.uint64(46)).astype(np.int32)
        self.crowd = int(np.bincount((self.keys >> np.uint64(46)).astype(int)).max())
        self.padded = np.concatenate([self.keys, np.zeros(self.crowd, np.uint64)])

    def probe(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each key among the sorted ones, and whether it is there."""
        at = self.starts[keys >> np.uint64(46)]
        place, there = at, self.padded[at] == keys
        for i in range(1, self.crowd):
            here = self.padded[at + i] == keys
            place, there = np.where(here, at + i, place), there | here
        return np.minimum(place, len(self.keys) - 1), there

    @classmethod
    def load(cls, path: str = DEFAULT_MODEL) -> Vocabulary:
        """Read a model file. It must have a piece for every byte, and no piece with a mark behind another character."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        entries, byte_ids, bodies, low = [], np.full(256, -1, np.int64), [b""] * size, 0.0
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                bodies[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                entries.append((piece, i, model.get_score(i)))
                bodies[i] = piece.replace(MARK, " ").encode()
                low = min(low, model.get_score(i))
        return cls.of(entries, byte_ids, bodies, low - UNKNOWN_COST)

    @classmethod
    def of(cls, entries: list[tuple[str, int, float]], byte_ids: np.ndarray, bodies: list[bytes], unknown_score: float) -> Vocabulary:
        if (byte_ids < 0).any():
            raise ValueError("the vocabulary lacks a piece for some byte")
        if any(MARK in piece.lstrip(MARK) for piece, _, _ in entries):
            raise ValueError("a piece reaches across words")
        keys = np.array([_hash_of(piece) for piece, _, _ in entries], np.uint64)
        order = np.argsort(keys)
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two pieces share a hash")
        return cls(keys[order], np.array([i for _, i, _ in entries], np.int64)[order], np.array([s for *_, s in entries], float)[order],
                   byte_ids, bodies, max(len(p) for p, _, _ in entries), unknown_score)


def _hash_of(piece: str) -> int:
    h = 0
    for c in piece:
        h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
    return int(_mixed(np.array([h], np.uint64))[0])


def _codes(word: str) -> np.ndarray:
    codes = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    codes[codes == ord(MARK)] = _LITERAL_MARK
    codes[codes == 32] = ord(MARK)
    return codes


def _search(vocabulary: Vocabulary, codes: np.ndarray) -> list[bytes]:
    """Piece ids (as bytes of int32) of words of equal length, one word a row."""
    n, length = codes.shape
    powers = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(vocabulary.longest, _BASE)]))
    sums = np.zeros((n, length + 1), np.uint64)
    for j in range(length):
        sums[:, j + 1] = sums[:, j] * _BASE + codes[:, j] + np.uint64(1)
    best = np.zeros((n, length + 1))
    came = np.zeros((n, length + 1), np.int32)  # length of the last piece
    piece = np.zeros((n, length + 1), np.int32)  # its id, -1 for an unknown character
    rows = np.arange(n)
    for j in range(1, length + 1):
        # Longest substring first: of equal scores the longer last piece is taken.
        sizes = np.arange(min(vocabulary.longest, j), 0, -1)
        keys = _mixed(sums[:, j, None] - sums[:, j - sizes] * powers[sizes])
        at, there = vocabulary.probe(keys)
        value = np.where(there, vocabulary.scores[at], -np.inf)
        value[:, -1] = np.where(there[:, -1], value[:, -1], vocabulary.unknown_score)
        value += best[:, j - sizes]
        top = value.argmax(axis=1)
        best[:, j] = value[rows, top]
        came[:, j] = sizes[top]
        piece[:, j] = np.where(there[rows, top], vocabulary.ids[at[rows, top]], -1)
    # Walk back from the end, all words at once; the pieces fill each row from the right.
    out = np.zeros((n, length), np.int32)
    place, used = np.full(n, length), np.zeros(n, np.int32)
    while (open_ := place > 0).any():
        used += open_
        r = rows[open_]
        out[r, length - used[r]] = piece[r, place[r]]
        place[r] -= came[r, place[r]]
    unknown = (out < 0).any(axis=1)
    return [_spelled(vocabulary, out[i, length - used[i]:], codes[i]) if unknown[i] else out[i, length - used[i]:].tobytes() for i in range(n)]


def _spelled(vocabulary: Vocabulary, pieces: np.ndarray, codes: np.ndarray) -> bytes:
    """Pieces with every unknown character spelled out in bytes."""
    out, at = [], 0
    for p in pieces.tolist():
        if p >= 0:
            out.append(p)
            at += len(vocabulary.bodies[p].decode())
        else:
            code = int(codes[at])
            body = (MARK if code == _LITERAL_MARK else " " if code == ord(MARK) else chr(code)).encode("utf-8", "surrogatepass")
            out += [int(vocabulary.byte_ids[b]) for b in body]
            at += 1
    return np.array(out, np.int32).tobytes()


class Encoder:
    """Encodes and decodes lists of texts; remembers the pieces of the words it has met, up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known: dict[str, bytes] = {}

    def _learn(self, words: Iterable[str]) -> None:
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        by_length: dict[int, list[str]] = {}
        for w in words:
            if w not in self.known:
                by_length.setdefault(len(w), []).append(w)
        for length, group in by_length.items():
            step = max(1, 200_000 // length)
            for at in range(0, len(group), step):
                part = group[at:at + step]
                codes = _codes("".join(part)).reshape(len(part), length)
                self.known.update(zip(part, _search(self.vocabulary, codes)))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Piece ids of each text. An empty text has none; any other is read with a blank before it."""
        cut = [WORDS.findall(" " + t) if t else [] for t in texts]
        fresh = {w for words in cut for w in words}
        self._learn(fresh)
        if any(w not in self.known for w in fresh):  # the memory was emptied on the way
            self._learn(fresh)
        known = self.known
        return [np.frombuffer(b"".join([known[w] for w in words]), np.int32) for words in cut]

    def decode(self, ids: np.ndarray) -> str:
        bodies = self.vocabulary.bodies
        text = b"".join([bodies[i] for i in ids.tolist()]).decode("utf-8", "surrogatepass")
        return text[1:]


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= SLICE_CHARS or i - start >= 2000:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", into: str = "tokens", decoded: str | None = None) -> DataFrame:
    """All columns and the piece ids of the text, as array<int>; a null text has a null list, an empty one an empty list.

    ``decoded`` names a further column for the text that the ids spell, so that a round trip takes one pass. Rows pass through
    as they are, whatever their ids or further columns. Columns already named like the new ones are replaced.
    """
    added = [into, *([decoded] if decoded else [])]
    base = docs.drop(*added)
    names, place = base.columns, base.columns.index(text_col)

    def coded(encoder: Encoder, part: pa.RecordBatch, texts: list) -> pa.RecordBatch:
        lists = encoder.encode([t or "" for t in texts])
        ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
        offsets = pa.array(ends.astype(np.int32), mask=np.array([t is None for t in texts] + [False]))
        flat = pa.array(np.concatenate([*lists, np.zeros(0, np.int32)]).astype(np.int32))
        columns = [*part.columns, pa.ListArray.from_arrays(offsets, flat)]
        if decoded:
            columns.append(pa.array([None if t is None else encoder.decode(x) for t, x in zip(texts, lists)], pa.string()))
        return pa.RecordBatch.from_arrays(columns, [*names, *added])

    def work(batches):
        encoder = Encoder(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):  # no more texts as Python strings than these
                part = batch.slice(at, 500)
                texts = part.column(place).to_pylist()
                for start, end in _slices([t or "" for t in texts]):
                    yield coded(encoder, part.slice(start, end - start), texts[start:end])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.mapInArrow(work, f"{schema}, `{into}` array<int>" + (f", `{decoded}` string" if decoded else ""))


def decode(docs: DataFrame, vocabulary: Vocabulary, tokens_col: str = "tokens", into: str = "decoded") -> DataFrame:
    """All columns and the text that the piece ids spell; a null list gives a null text."""
    base = docs.drop(into)
    names, place = base.columns, base.columns.index(tokens_col)

    def work(batches):
        encoder = Encoder(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                column = part.column(place)
                values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
                texts = [encoder.decode(values[a:b]) if there else None
                         for a, b, there in zip(offsets, offsets[1:], column.is_valid().to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*names, into])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.mapInArrow(work, f"{schema}, `{into}` string")
