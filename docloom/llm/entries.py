"""Counts of byte strings in arrays: hashed, grouped and added up without a Python object for each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from docloom.llm.minhash import _mixed, _powers
from docloom.llm.suffixes import _ragged

_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_UNBASES = tuple(np.uint64(pow(int(b), -1, 1 << 64)) for b in _BASES)


def hash_words(a: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
    """A 64-bit hash of each word of some bytes; there are two, for pairs that name a word."""
    sums = np.zeros(len(a) + 1, np.uint64)
    values = a.astype(np.uint64)
    values += np.uint64(1)
    values *= _powers(_BASES[which], len(a))
    np.cumsum(values, out=sums[1:])
    return _mixed((sums[ends] - sums[starts]) * _powers(_UNBASES[which], len(a) + 1)[starts])


def runs(key: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order that puts equal pairs of hashes together, and where each pair begins."""
    order = np.argsort(key, kind="stable")
    k, o = key[order], other[order]
    same = k[1:] == k[:-1]
    if (same & (o[1:] != o[:-1])).any():  # one hash for two strings
        order = np.lexsort((other, key))
        k, o = key[order], other[order]
        same = (k[1:] == k[:-1]) & (o[1:] == o[:-1])
    return order, np.flatnonzero(np.concatenate([[True], ~same])[:len(k)])


class Entries:
    """Counts of strings by group: group, two hashes that name string and group, occurrences, documents, and the string's bytes."""

    def __init__(self, group, key, other, n, docs, lengths, data):
        self.group, self.key, self.other, self.n, self.docs, self.lengths, self.data = group, key, other, n, docs, lengths, data

    def __len__(self) -> int:
        return len(self.key)

    @classmethod
    def of(cls, group: np.ndarray, key: np.ndarray, other: np.ndarray, a: np.ndarray, starts: np.ndarray, lengths: np.ndarray, doc: np.ndarray | None = None) -> Entries:
        """Counts of occurrences, which come in order of their documents; without documents those count 0."""
        order, first = runs(key, other)
        n = np.diff(np.append(first, len(order)))
        docs = np.zeros(len(first), np.int64)
        if doc is not None and len(first):
            doc = doc[order]
            changed = np.concatenate([[True], doc[1:] != doc[:-1]])
            changed[first] = True
            docs = np.add.reduceat(changed, first, dtype=np.int64)
        own = order[first]
        return cls(group[own], key[own], other[own], n, docs, lengths[own], a[_ragged(starts[own], lengths[own])])

    @classmethod
    def joined(cls, parts: list[Entries], one_document: bool = False) -> Entries:
        """Entries added up; of parts of one document each string counts one document."""
        group, key, other, n, docs, lengths, data = (np.concatenate([getattr(p, c) for p in parts]) for c in ("group", "key", "other", "n", "docs", "lengths", "data"))
        order, first = runs(key, other)
        own = order[first]
        n, docs = (np.add.reduceat(x[order], first) if len(first) else x for x in (n, docs))
        starts = np.cumsum(lengths) - lengths
        return cls(group[own], key[own], other[own], n, np.minimum(docs, 1) if one_document else docs, lengths[own], data[_ragged(starts[own], lengths[own])])


def strings(entries: Entries, rows: int = 100_000) -> Iterator[tuple[slice, pa.Array]]:
    """The strings of some entries at a time, as Arrow arrays."""
    ends = np.cumsum(entries.lengths)
    for at in range(0, len(entries), rows):
        part = slice(at, at + rows)
        first = ends[at] - entries.lengths[at]
        places = np.concatenate([[0], ends[part] - first]).astype(np.int32)
        data = np.ascontiguousarray(entries.data[first:ends[part][-1]])
        yield part, pa.StringArray.from_buffers(len(places) - 1, pa.py_buffer(places), pa.py_buffer(data))
