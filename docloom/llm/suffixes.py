"""Removal of repeated passages with a logarithmic family of suffix arrays.

Every string of ``LENGTH`` bytes holds one anchor: of its runs of ``GRAM`` bytes the one
with the least hash. Equal strings have equal anchors, so a suffix array of the suffixes that
start at anchors, about one in eighteen, finds every repeat of that length. The array is dealt
into buckets by the hash of a suffix's first bytes; in a bucket suffixes are sorted by them.

Documents arrive in batches of ascending ids. A batch gets its suffix array, which is scanned
alongside the arrays of the levels so far, both in order, as in a merge; anchors that
some other document has as well are noted on both sides. Then the batch becomes a level, and
levels made of equally many batches are merged, so there are never more than a logarithm of them.

The strings around noted anchors are compared in two steps. First whole stretches, those of all strings
with one anchor: a stretch that a document with a smaller id has as well is marked; an anchor whose
stretches are all equal is settled by that. Only where stretches around one anchor differ, at the edges of copies,
are single strings compared, by 64 bits of hash among those of one anchor.

A prefix, stretch or copy that a third of all documents share costs each task one entry: what repeats inside
a task is settled there. An anchor with many different stretches in one task is common; its strings are
dealt by their own hash instead, so that no group grows with it.
"""

from __future__ import annotations

import gc
import hashlib
import time
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import columns_of, dropped, saved
from docloom.llm.minhash import _ODD, _UNODD, _mixed, _powers

LENGTH, GRAM = 50, 16
RUNS = LENGTH - GRAM + 1  # anchors are chosen among so many
PIECE = 1 << 20  # bytes of a text taken at once
FLUSH = 1 << 24  # bytes of texts whose entries are gathered before they are handed on
_PLACE = np.uint64(PIECE * 2 - 1)
_BASE2 = np.uint64(0xD6E8FEB86659FD93)
_UNBASE2 = np.uint64(pow(int(_BASE2), -1, 1 << 64))


def _sums(a: np.ndarray, base: np.uint64) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum((a.astype(np.uint64) + np.uint64(1)) * _powers(base, len(a)))])


def _stirred(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _hash_at(sums: np.ndarray, inverse: np.uint64, starts: np.ndarray, length) -> np.ndarray:
    return _stirred((sums[starts + length] - sums[starts]) * _powers(inverse, len(sums))[starts])


def _pieces(body: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """Parts of a text such that each string of ``LENGTH`` bytes lies in exactly one; with their offsets."""
    a = np.frombuffer(body, np.uint8)
    for at in range(0, max(1, len(a) - LENGTH + 1), PIECE):
        part = a[at:at + PIECE + LENGTH - 1]
        if len(part) >= LENGTH:
            yield at, part


def anchors(a: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each stretch of strings with one anchor: first string, number of strings, and the anchor's key:
    its first eight bytes as a number, so that numbers sort as suffixes do, and 32 bits of its hash."""
    n = len(a) - GRAM + 1
    h = _stirred((sums[GRAM:] - sums[:n]) * _powers(_UNODD, n))
    least = (h & ~_PLACE) | np.arange(n, dtype=np.uint64)  # ties go to the leftmost
    width = 1
    while width * 2 <= RUNS:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:len(least) - (RUNS - width)], least[RUNS - width:])
    at = (least & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    at, count = at[first], np.diff(np.concatenate([first, [len(at)]]))
    head = np.zeros(len(at), np.uint64)
    for i in range(8):
        head = head << np.uint64(8) | a[at + i].astype(np.uint64)
    return first, count, head, (h[at] >> np.uint64(32)).astype(np.uint32)


def _named(head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """One number for a suffix key."""
    return _mixed(head ^ _mixed(tail.astype(np.uint64) + np.uint64(1)))


def _body(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


PART = "kind int, bucket int, doc long, head binary, tail binary, docs binary, open binary"
_PART = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("doc", pa.int64()), ("head", pa.binary()), ("tail", pa.binary()), ("docs", pa.binary()), ("open", pa.binary())])
ENTRY, NOTED = 0, 1


def _noted(doc: np.ndarray, names: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Rows of the keys to note, one a document."""
    order = np.lexsort((names, doc))
    doc, names = doc[order], names[order]
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, int)
    ends = np.append(first[1:], len(doc))
    n = len(first)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, NOTED, np.int32)), pa.array((doc[first] % buckets).astype(np.int32)), pa.array(doc[first]),
         pa.array([np.unique(names[a:b]).tobytes() for a, b in zip(first, ends)], pa.binary()), *[pa.nulls(n, pa.binary())] * 3], schema=_PART)


def _entries(bucket: int, head: np.ndarray, tail: np.ndarray, docs: np.ndarray, open_: np.ndarray) -> pa.RecordBatch:
    """A bucket of an array: keys in order, the document of each, and whether that document is still to be noted for the key."""
    return pa.RecordBatch.from_pylist([{"kind": ENTRY, "bucket": bucket, "head": head.tobytes(), "tail": tail.tobytes(), "docs": docs.tobytes(),
                                        "open": np.packbits(open_).tobytes()}], _PART)


def _ordered(first_key: np.ndarray, second_key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by two keys, the second of so many bits, and where each pair of keys begins in it."""
    order = np.argsort(first_key)
    run = np.zeros(len(order), np.uint64)
    run[1:] = np.cumsum(first_key[order][1:] != first_key[order][:-1])
    if len(run) and int(run[-1]) >> (64 - bits):  # more keys than a number has room for beside the second one
        order = np.lexsort((second_key, first_key))
        return order, _heads(first_key[order], second_key[order])
    both = run << np.uint64(bits) | second_key[order].astype(np.uint64)
    inner = np.argsort(both)
    return order[inner], _heads(both[inner])


def _grouped(head: np.ndarray, tail: np.ndarray):
    """The order of suffixes, where each key begins in it, and how often it occurs."""
    order, first = _ordered(head, tail, 32)
    return order, first, np.diff(np.append(first, len(head)))


def _suffix_parts(buckets: int):
    """Map task: the suffixes of its documents, one entry for each key, by bucket."""

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        head, tail, docs = (np.concatenate([h[i] for h in held]) for i in range(3))
        order, first, size = _grouped(head, tail)
        head, tail, docs = head[order], tail[order], docs[order]
        several = np.minimum.reduceat(docs, first) != np.maximum.reduceat(docs, first) if len(first) else first.astype(bool)
        shared = np.repeat(several, size)
        yield _noted(docs[shared], _named(head[shared], tail[shared]), buckets)
        # Of a key that several documents share all are noted, and no one is left to be.
        head, tail, docs, open_ = head[first], tail[first], docs[first], ~several
        bucket = (_named(head, tail) >> np.uint64(32)).astype(np.int64) % buckets
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in range(buckets):
            i = order[edges[b]:edges[b + 1]]
            if len(i):
                yield _entries(b, head[i], tail[i], docs[i], open_[i])

    def work(batches):
        held, size = [], 0
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                body = _body(text.as_py())
                for _, a in _pieces(body):
                    _, _, head, tail = anchors(a, _sums(a, _ODD))
                    held.append((head, tail, np.full(len(head), doc, np.int64)))
                size += len(body)
                if size >= FLUSH and held:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return work


def _arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    def joined(name: str, kind) -> np.ndarray:
        return np.concatenate([np.frombuffer(b, kind) for b in table.column(name).to_pylist()] + [np.zeros(0, kind)])

    bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=len(d) // 8) for b, d in zip(table.column("open").to_pylist(), table.column("docs").to_pylist())]
    return joined("head", np.uint64), joined("tail", np.uint32), joined("docs", np.int64), np.concatenate([*bits, np.zeros(0, np.uint8)]).astype(bool)


def _merged(head: np.ndarray, tail: np.ndarray, docs: np.ndarray, open_: np.ndarray, buckets: int):
    """Scan sorted suffixes of several arrays together: rows to note, and the merged array."""
    order, first, size = _grouped(head, tail)
    head, tail, docs, open_ = head[order], tail[order], docs[order], open_[order]
    met = np.repeat(size > 1, size) & open_
    noted = _noted(docs[met], _named(head[met], tail[met]), buckets)
    return noted, head[first], tail[first], docs[first], open_[first] & (size == 1)


class SuffixFamily:
    """The levels so far, in the shared folder. ``add`` takes a batch and returns the keys to note, by document."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.levels: list[tuple[int, DataFrame]] = []  # (batches it holds, its array), largest first

    def add(self, docs: DataFrame, last: bool = False) -> DataFrame:
        """Note what the batch shares with itself and all levels; make it a level, unless it is the last."""
        buckets = self.buckets
        parts = docs.select("doc_id", "text").mapInArrow(_suffix_parts(buckets), PART)
        levels = parts.limit(0)
        for _, level in self.levels:
            levels = levels.union(level)

        def scan(own: pa.Table, old: pa.Table) -> pa.Table:
            kinds = np.array(own.column("kind").to_pylist(), int)
            passed, entries = own.filter(pa.array(kinds == NOTED)), own.filter(pa.array(kinds == ENTRY))
            mine = _arrays(entries)
            noted, *_ = _merged(*[np.concatenate(x) for x in zip(mine, _arrays(old))], buckets)
            out = [passed.combine_chunks().cast(_PART), pa.Table.from_batches([noted])]
            if not last and len(mine[0]):
                _, *level = _merged(*mine, buckets)
                out.append(pa.Table.from_batches([_entries(entries.column("bucket")[0].as_py(), *level)]))
            return pa.concat_tables(out)

        made = saved(parts.groupBy("bucket").cogroup(levels.groupBy("bucket")).applyInArrow(scan, PART), "suffixes")
        if not last:
            # Level and notes are kept apart, so that a level can go when it is merged.
            level = saved(made.where(f"kind = {ENTRY}"), "level")
            notes = saved(made.where(f"kind = {NOTED}").select("doc", F.col("head").alias("names")), "notes")
            dropped(made)
            self.levels.append((1, level))
            self._merge()
            return notes
        for _, level in self.levels:
            dropped(level)
        return made.where(f"kind = {NOTED}").select("doc", F.col("head").alias("names"))

    def _merge(self) -> None:
        buckets = self.buckets
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (n, one), (_, two) = self.levels.pop(), self.levels.pop()

            def merge(table: pa.Table) -> pa.Table:
                _, *both = _merged(*_arrays(table), buckets)
                return pa.Table.from_batches([_entries(table.column("bucket")[0].as_py(), *both)])

            level = saved(one.union(two).groupBy("bucket").applyInArrow(merge, PART), "level")
            self.levels.append((2 * n, level))
            dropped(one), dropped(two)


def _release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished steps now, not when the driver next happens to collect."""
    for _ in range(2):  # references from Python go in the first round, what they held in the second
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


ROW = ("kind int, bucket int, doc long, body long, names binary, wholes binary, strings binary, rows binary, places binary, counts binary, "
       "texts binary, docs binary, bodies binary")
_ROW = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("doc", pa.int64()), ("body", pa.int64()),
                  *[(c, pa.binary()) for c in ("names", "wholes", "strings", "rows", "places", "counts", "texts", "docs", "bodies")]])
#: Kinds of rows: stretches or single strings to compare in a bucket, spans to remove of a document.
STRETCHES, STRINGS, MARKED = 0, 1, 2
#: Entries of one anchor that a bucket may have to hold.
GROUP_ROWS = 200_000
#: Strings compared at once; more only where one anchor has more.
AT_ONCE = 250_000


def _marked(doc: np.ndarray, body: np.ndarray, start: np.ndarray, end: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row a document with its spans, joined where they touch."""
    order = np.lexsort((start, body, doc))
    doc, body, spans = doc[order], body[order], np.stack([start[order], end[order]], 1).astype(np.int64)
    first = _heads(doc, body)
    ends = np.append(first[1:], len(doc))
    none = pa.nulls(len(first), pa.binary())
    columns = {"kind": pa.array(np.full(len(first), MARKED, np.int32)), "bucket": pa.array((doc[first] % buckets).astype(np.int32)),
               "doc": pa.array(doc[first]), "body": pa.array(body[first]),
               "places": pa.array([_joined(spans[a:b]).tobytes() for a, b in zip(first, ends)], pa.binary())}
    return pa.RecordBatch.from_arrays([columns.get(f.name, none) for f in _ROW], schema=_ROW)


def _joined(spans: np.ndarray) -> np.ndarray:
    """Spans in order of their starts as maximal runs."""
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.flatnonzero(np.concatenate([[True], spans[1:, 0] > reach[:-1]]))
    return np.stack([spans[first, 0], reach[np.append(first[1:] - 1, len(spans) - 1)]], 1)


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Places where sorted rows begin a new key."""
    if not len(keys[0]):
        return np.zeros(0, int)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _spread(values: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """A value for each group as a value for each of its rows."""
    return np.repeat(values, np.diff(np.append(first, n)))


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of runs that begin at ``starts``, one run after the other."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))


def _send(kind: int, bucket: np.ndarray, row: np.ndarray, docs: np.ndarray, bodies: np.ndarray, texts=None, **columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What goes to each bucket, as one row of packed columns; ``texts`` gives the bytes of chosen entries."""
    order = np.argsort(bucket, kind="stable")
    filled = np.flatnonzero(np.bincount(bucket)) if len(bucket) else bucket
    edges = np.searchsorted(bucket[order], [filled, filled + 1])
    for b, lo, hi in zip(filled, *edges):
        i = order[lo:hi]
        known, rows = np.unique(row[i], return_inverse=True)
        yield pa.RecordBatch.from_pylist([{
            "kind": kind, "bucket": int(b), "rows": rows.astype(np.uint32).tobytes(), "docs": docs[known].tobytes(), "bodies": bodies[known].tobytes(),
            **({"texts": zlib.compress(texts(i), 1)} if texts else {}), **{name: values[i].tobytes() for name, values in columns.items()}}], _ROW)


def _split(table: pa.Table, kind: int, *columns: str) -> tuple[pa.Table, list[dict]]:
    """Rows of other kinds, to pass on, and packed columns of those of one kind, where they lie in the table."""
    own = np.array(table.column("kind").to_pylist(), int) == kind
    rows = [{c: batch.column(c)[i].as_buffer() for c in ("rows", "docs", "bodies", *columns)}
            for batch in table.to_batches() for i in np.flatnonzero(batch.column("kind").to_numpy() == kind).tolist()]
    return table.filter(pa.array(~own)).cast(_ROW), rows


def _unpacked(rows: list[dict], **kinds) -> dict[str, np.ndarray]:
    """Packed columns end to end, with the doc and body of each entry."""
    places = [np.frombuffer(r["rows"], np.uint32) for r in rows]
    out = {name: np.concatenate([np.frombuffer(r[name], kind) for r in rows] + [np.zeros(0, kind)]) for name, kind in kinds.items()}
    for name, column in (("doc", "docs"), ("body", "bodies")):
        out[name] = np.concatenate([np.frombuffer(r[column], np.int64)[x] for r, x in zip(rows, places)] + [np.zeros(0, np.int64)])
    return out


def _strings_of(flat: np.ndarray, starts: np.ndarray, count: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and bucket of each string of stretches that lie in ``flat`` end to end, the stretch it is of and its place there."""
    parts = []
    edges = np.unique(np.append(np.searchsorted(starts, np.arange(0, len(flat), PIECE // 2)), len(starts)))
    for lo, hi in zip(edges, edges[1:]):
        a = flat[starts[lo]:starts[hi] if hi < len(starts) else len(flat)]
        at = _ragged(starts[lo:hi] - starts[lo], count[lo:hi])
        bucket = (_hash_at(_sums(a, _BASE2), _UNBASE2, at, LENGTH) >> np.uint64(33)).astype(np.int64) % buckets
        owner = np.repeat(np.arange(lo, hi), count[lo:hi])
        parts.append((_hash_at(_sums(a, _ODD), _UNODD, at, LENGTH), bucket, owner, at - (starts[owner] - starts[lo])))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _texts(batches) -> Iterator[tuple]:
    """doc_id, body, bytes of the text, and the packed list that came with it."""
    for batch in batches:
        for doc, body, packed, lists in zip(*[batch.column(c) for c in ("doc_id", "body", "packed", "lists")]):
            yield doc.as_py(), body.as_py(), zlib.decompress(packed.as_py()), lists.as_py()


def _stretches(buckets: int, many: int):
    """Map task: the stretches around noted anchors, by bucket of the anchor; what repeats in the task is settled.

    Up to ``many`` different stretches of an anchor are sent on as such each time entries are handed on.
    """

    def work(batches):
        held, size = [], 0
        for doc, body, text, lists in _texts(batches):
            noted = np.unique(np.concatenate([np.frombuffer(x, np.uint64) for x in lists]))
            for offset, a in _pieces(text):
                sums = _sums(a, _ODD)
                first, count, head, tail = anchors(a, sums)
                names = _named(head, tail)
                hit = np.isin(names, noted)
                first, count, names = first[hit], count[hit], names[hit]
                long = count - 1 + LENGTH
                whole = _hash_at(sums, _UNODD, first, long) + count.astype(np.uint64) * _BASE2
                held.append((doc, body, names, whole, first + offset, count, a[_ragged(first, long)]))
                size += len(held[-1][-1])
            if size >= FLUSH:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        docs, bodies = np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], np.int64)
        row = np.repeat(np.arange(len(held)), [len(h[2]) for h in held])
        name, whole, place, count, flat = (np.concatenate([h[i] for h in held]) for i in range(2, 7))
        long = count - 1 + LENGTH
        start = np.cumsum(long) - long
        order, first = _ordered(name, whole >> np.uint64(20), 44)
        row, name, whole, place, count, long, start = (x[order] for x in (row, name, whole, place, count, long, start))
        doc = docs[row]
        later = doc > _spread(np.minimum.reduceat(doc, first) if len(first) else first, first, len(doc))
        yield _marked(doc[later], bodies[row[later]], place[later], place[later] + long[later], buckets)
        # An anchor with many stretches here is common whatever other tasks hold; one entry of it says so.
        group, begins = _heads(name), np.zeros(len(name), np.int64)
        begins[first] = 1
        kinds = np.add.reduceat(begins, group) if len(group) else group
        common = _spread(kinds > many, group, len(name)) & ~later
        at = np.flatnonzero(common)
        if len(at):
            part = flat[_ragged(start[at], long[at])]
            string, bucket, owner, shift = _strings_of(part, np.cumsum(long[at]) - long[at], count[at], buckets)
            yield from _send(STRINGS, bucket, row[at][owner], docs, bodies, strings=string, places=(place[at][owner] + shift).astype(np.uint32))
        sign = np.zeros(len(name), bool)
        sign[group] = kinds > many
        at = np.flatnonzero((~later & ~common) | sign)
        sent = np.where(sign, 0, count)[at]

        def texts(i: np.ndarray) -> bytes:
            i = i[sent[i] > 0]
            return flat[_ragged(start[at[i]], long[at[i]])].tobytes()

        yield from _send(STRETCHES, (name[at] >> np.uint64(32)).astype(np.int64) % buckets, row[at], docs, bodies, texts, names=name[at],
                         wholes=whole[at], places=place[at].astype(np.uint32), counts=sent.astype(np.uint8))

    return work


def _settle_stretches(buckets: int):
    """Bucket task: mark repeated stretches, and repeated strings of anchors with several; pass on strings of common anchors."""

    def work(table: pa.Table) -> pa.Table:
        passed, rows = _split(table, STRETCHES, "names", "wholes", "places", "counts", "texts")
        e = _unpacked(rows, names=np.uint64, wholes=np.uint64, places=np.uint32, counts=np.uint8)
        count, place = e["counts"].astype(np.int64), e["places"].astype(np.int64)
        real, long = count > 0, np.where(count > 0, count - 1 + LENGTH, 0)
        order = np.lexsort((e["doc"], e["wholes"], real, e["names"]))
        name, whole, doc, sure = e["names"][order], e["wholes"][order], e["doc"][order], real[order]
        first, group, begins = _heads(name, whole, sure), _heads(name), np.zeros(len(name), np.int64)
        begins[first] = 1
        later = (doc > _spread(doc[first], first, len(doc))) & sure
        kinds = np.add.reduceat(begins, group) if len(group) else group
        signed = ~sure[group] if len(group) else group.astype(bool)
        open_, common = np.zeros(len(name), bool), np.zeros(len(name), bool)
        open_[order] = _spread((kinds > 1) & ~signed, group, len(name)) & ~later
        common[order] = _spread(signed, group, len(name)) & ~later & sure
        i = order[later]
        out = [passed, pa.Table.from_batches([_marked(e["doc"][i], e["body"][i], place[i], place[i] + long[i], buckets)])]
        del order, name, whole, doc, sure, first, begins, later, i
        # The texts are opened one row at a time, for the entries that still need them.
        found, at = [], 0
        for r in rows:
            n = len(r["counts"])
            own = np.arange(at, at + n)
            at += n
            start = np.cumsum(long[own]) - long[own]
            if not (open_[own] | common[own]).any():
                continue
            flat = np.frombuffer(zlib.decompress(r["texts"]), np.uint8)
            for chosen, far in ((open_, False), (common, True)):
                j = np.flatnonzero(chosen[own])
                if not len(j):
                    continue
                part = flat[_ragged(start[j], long[own[j]])]
                if far:
                    string, bucket, owner, shift = _strings_of(part, np.cumsum(long[own[j]]) - long[own[j]], count[own[j]], buckets)
                    k = own[j][owner]
                    known, of = np.unique(k, return_inverse=True)
                    out += [pa.Table.from_batches([b]) for b in _send(STRINGS, bucket, of, e["doc"][known], e["body"][known], strings=string,
                                                                     places=(place[k] + shift).astype(np.uint32))]
                else:
                    found.append((own[j], part))
        if found:
            spans = _compared(*(np.concatenate(x) for x in zip(*found)), e["names"], e["doc"], e["body"], place, count, buckets)
            out.append(pa.Table.from_batches([_marked(*spans, buckets)]))
        return pa.concat_tables(out)

    return work


def _compared(own: np.ndarray, flat: np.ndarray, name: np.ndarray, doc: np.ndarray, body: np.ndarray, place: np.ndarray, count: np.ndarray, buckets: int) -> list[np.ndarray]:
    """Repeated runs among the strings of some entries, whose stretches lie in ``flat`` end to end, a few anchors at a time."""
    long = count[own] - 1 + LENGTH
    start = np.cumsum(long) - long
    order = np.argsort(name[own], kind="stable")
    group = np.append(_heads(name[own][order]), len(order))
    reach = np.cumsum(np.add.reduceat(count[own][order], group[:-1]))
    runs, at = [], 0
    while at < len(reach):
        to = max(at + 1, int(np.searchsorted(reach, AT_ONCE + (reach[at - 1] if at else 0), "right")))
        i = order[group[at]:group[to]]
        string, _, owner, shift = _strings_of(flat[_ragged(start[i], long[i])], np.cumsum(long[i]) - long[i], count[own[i]], buckets)
        k = own[i][owner]
        runs.append(_repeats(string, doc[k], body[k], place[k] + shift, name[k]))
        at = to
    return [np.concatenate(x) for x in zip(*runs)]


def _repeats(string: np.ndarray, doc: np.ndarray, body: np.ndarray, place: np.ndarray, *also: np.ndarray) -> tuple[np.ndarray, ...]:
    """Doc, body, start and end of the runs of strings that a document with a smaller id holds too."""
    order = np.lexsort((doc, string, *also))
    string, *also = (x[order] for x in (string, *also))
    first = _heads(string, *also)
    order = order[doc[order] > _spread(doc[order[first]], first, len(order))]
    order = order[np.lexsort((place[order], body[order], doc[order]))]
    doc, body, place = doc[order], body[order], place[order]
    new = np.ones(len(order), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (body[1:] != body[:-1]) | (place[1:] - place[:-1] > LENGTH)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(order))[:len(first)] - 1
    return doc[first], body[first], place[first], place[last] + LENGTH


def _settle_strings(buckets: int):
    """Bucket task: the strings of common anchors."""

    def work(table: pa.Table) -> pa.Table:
        passed, rows = _split(table, STRINGS, "strings", "places")
        e = _unpacked(rows, strings=np.uint64, places=np.uint32)
        parts = np.uint64(1 + len(e["strings"]) // AT_ONCE)
        runs = []
        for part in range(int(parts)):
            i = np.flatnonzero(e["strings"] % parts == np.uint64(part))
            runs.append(_repeats(e["strings"][i], e["doc"][i], e["body"][i], e["places"][i].astype(np.int64)))
        return pa.concat_tables([passed, pa.Table.from_batches([_marked(*(np.concatenate(x) for x in zip(*runs)), buckets)])])

    return work


def _packed(docs: DataFrame) -> DataFrame:
    """(doc_id, body, packed): texts as compressed bytes, for the joins that move them; a null text stays null."""
    def work(batches):
        for batch in batches:
            texts = [None if t is None else zlib.compress(_body(t), 1) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("body"), pa.array(texts, pa.binary())], ["doc_id", "body", "packed"])

    return docs.select("doc_id", "body", "text").mapInArrow(work, "doc_id long, body long, packed binary")


def repeated_spans(docs: DataFrame, batches: int = 4) -> DataFrame:
    """(doc_id, body, lists): for documents with repeats, lists of the runs to remove; ``docs`` has doc_id, text, body."""
    spark = docs.sparkSession
    size, least, most = docs.agg(F.sum(F.octet_length("text")), F.min("doc_id"), F.max("doc_id")).first()
    buckets = int(max(32, (size or 0) >> 24))  # about a million anchors each
    many = max(1, GROUP_ROWS // (1 + (size or 0) // FLUSH))
    edges = sorted({int(e) for e in docs.approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.01)}) if least is not None and batches > 1 else []
    bounds = [least if least is not None else 0, *[e for e in edges if least < e <= most], (most if most is not None else 0) + 1]
    family, noted = SuffixFamily(spark, buckets), None
    for i, (low, high) in enumerate(zip(bounds, bounds[1:])):
        found = family.add(docs.where((F.col("doc_id") >= low) & (F.col("doc_id") < high)), last=i == len(bounds) - 2)
        noted = found if noted is None else noted.union(found)
        _release(spark)
    lists = noted.groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list("names").alias("lists"))
    rows = _packed(docs).join(lists.hint("merge"), "doc_id")
    settled = saved(rows.mapInArrow(_stretches(buckets, many), ROW).groupBy("bucket").applyInArrow(_settle_stretches(buckets), ROW), "stretches")
    _release(spark)
    strings = settled.where(F.col("kind") == STRINGS).groupBy("bucket").applyInArrow(_settle_strings(buckets), ROW)
    marks = settled.where(F.col("kind") == MARKED).union(strings)
    return marks.groupBy(F.col("doc").alias("doc_id"), "body").agg(F.collect_list("places").alias("lists"))


def _union(spans: list[bytes]) -> np.ndarray:
    """Runs of several lists as maximal runs in order."""
    both = np.concatenate([np.frombuffer(s, np.int64).reshape(-1, 2) for s in spans])
    return _joined(both[np.argsort(both[:, 0], kind="stable")])


def remove_repeats(docs: DataFrame, batches: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove every byte that a string of 50 bytes covers which also starts in a document with a smaller id.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal runs), kept_sha256 and kept (the bytes that stay; binary,
    for a cut may split a character). Strings are judged on the input. A null or empty text, and one shorter than 50 bytes,
    loses nothing. Rows with a null id lose nothing and take nothing from others. Rows of equal id do not count
    as repeats of each other. An empty table gives an empty result. Other columns are ignored.
    """
    rows = columns_of(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = rows.withColumn("body", F.xxhash64("text"))
    long_enough = rows.where((F.octet_length("text") >= LENGTH) & F.col("doc_id").isNotNull())
    joined = _packed(rows).join(repeated_spans(long_enough, batches).hint("merge"), ["doc_id", "body"], "left")

    def cut(parts):
        for part in parts:
            for at in range(0, part.num_rows, 500):
                batch = part.slice(at, 500)
                out = []
                for packed, lists in zip(batch.column("packed").to_pylist(), batch.column("lists").to_pylist()):
                    body, kept, removed, runs = zlib.decompress(packed) if packed else b"", None, 0, 0
                    if lists:
                        gone = _union(lists)
                        edges = np.concatenate([[0], gone.ravel(), [len(body)]]).reshape(-1, 2)
                        kept = b"".join(body[a:b] for a, b in edges.tolist())
                        removed, runs = int((gone[:, 1] - gone[:, 0]).sum()), len(gone)
                    kept = body if kept is None else kept
                    out.append((len(body), removed, runs, hashlib.sha256(kept).hexdigest(), kept))
                columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))]
                if out:
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return joined.select("doc_id", "packed", "lists").mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
