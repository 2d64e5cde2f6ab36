"""Phrase collocations, mined by SON partitioning.

The documents are cut into shards. A phrase that occurs ``support`` times in all occurs at least its proportional part of
that in one shard, so each shard is mined completely at a support lowered by its share of the language's bytes; the union of what is
frequent somewhere holds every phrase that is frequent on the whole. From the shards' counts follows the most that a
phrase can reach: where it was not frequent it stays below that shard's support. What cannot reach the support goes, and the
rest is counted exactly over all documents.

A shard is not one task: its tasks count on their own, in bounded memory, and their counts are summed by shard. Mining goes
by length. Words and pairs come first; longer phrases are formed only of pairs that can still reach the support. What a pass may look for
travels as a bit table of hashes of fixed size. A false hit costs a row and is counted like any other, so hashes never
decide a result: the last pass counts phrases by their words.

Counts are shuffled packed: a task sorts what it holds by ranges of the hash and hands on one row for each range, with the counts, and
the hashes or words, of all languages in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import columns_of, joined_small, saved
from docloom.llm.entries import _BASES, Entries, hash_words
from docloom.llm.minhash import _mixed, _powers
from docloom.llm.suffixes import _ragged
from docloom.operators.numbering import ranged_positions

SHARDS = 10
LONGEST = 4  # words of a phrase
#: Bits of the table that says what to look for, as a power of two (16 MB); fuller tables only let more through.
TABLE_BITS = 27
_BLOCK_BITS = 20  # of the parts in which it is put together
#: Bytes of text looked at together, and phrases that a task holds before it hands counts on.
PIECE_BYTES, HELD = 1_000_000, 2_000_000
#: Bytes of text whose counts make one part of a shuffle, and the most parts.
PART_BYTES, MOST_PARTS = 1 << 22, 10_000
_PACKED = "shard int, part int, langs array<string>, sizes array<long>, n binary, h binary, lengths binary, data binary"
#: Mining needs no more of a hash than this: equal beginnings are counted together, which only lets more through.
_BEGINNING = np.uint64(0xFFFFFFFFFF000000)
_KIND = np.zeros(256, np.uint8)  # 1: between words, 2: between pieces
_KIND[[9, 32]] = 1
_KIND[[*b".,;:!?", 10, 11, 12, 13]] = 2


class Words:
    """The words of some texts: where they are, in which piece, of which language."""

    def __init__(self, body: bytes, lang_of: np.ndarray, text_ends: np.ndarray):
        a = np.frombuffer(body, np.uint8)
        self.bytes = a = np.where((a >= 65) & (a <= 90), a + np.uint8(32), a)
        kind = _KIND[a]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], kind > 0, [True]]).astype(np.int8)))
        self.starts, self.ends = edge[::2], edge[1::2]
        self.piece = np.cumsum(kind == 2)[self.starts] if len(a) else np.zeros(0, np.int64)
        self.lang = lang_of[np.searchsorted(text_ends, self.starts, "right")] if len(self.starts) else np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.starts)

    def spelled(self) -> tuple[np.ndarray, np.ndarray]:
        """The words end to end with one blank after each, and where each begins there; one more place for the end."""
        lengths = self.ends - self.starts
        places = np.concatenate([[0], np.cumsum(lengths + 1)])
        out = np.full(places[-1], 32, np.uint8)
        out[_ragged(places[:-1], lengths)] = self.bytes[_ragged(self.starts, lengths)]
        return out, places

    def hashes(self, seeds: np.ndarray, which: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, places, hashes) of all phrases of each length; ``seeds`` is a number for each language."""
        if not len(self):
            return
        word = hash_words(self.bytes, self.starts, self.ends, which)
        own = _mixed(word ^ seeds[self.lang])
        yield 1, np.arange(len(own)), own
        for n in range(2, LONGEST + 1):
            if len(word) < n:
                return
            own = _mixed(own[:-1] * _BASES[0] + word[n - 1:] + np.uint64(n))
            yield n, np.flatnonzero(self.piece[:len(own)] == self.piece[n - 1:]), own


def _readings(texts: list[str | None], langs: np.ndarray) -> Iterator[Words]:
    """Texts in stretches of some megabytes. A long text is cut only between pieces."""
    held, lang_of, ends, size = [], [], [], 0
    for text, lang in zip(texts, langs.tolist()):
        body = (text or "").encode("utf-8", "surrogatepass")
        while body:
            part, body = _cut(body)
            held.append(part)
            size += len(part) + 1
            lang_of.append(lang), ends.append(size)
            if size >= PIECE_BYTES:
                yield Words(b"\n".join(held) + b"\n", np.array(lang_of), np.array(ends))
                held, lang_of, ends, size = [], [], [], 0
    if held:
        yield Words(b"\n".join(held) + b"\n", np.array(lang_of), np.array(ends))


def _cut(body: bytes) -> tuple[bytes, bytes]:
    if len(body) <= PIECE_BYTES:
        return body, b""
    first = _KIND[np.frombuffer(body[:PIECE_BYTES], np.uint8)] == 2
    at = np.flatnonzero(first)
    if not len(at):  # a piece longer than a stretch stays whole
        rest = np.flatnonzero(_KIND[np.frombuffer(body, np.uint8)] == 2)
        return (body[:rest[0]], body[rest[0] + 1:]) if len(rest) else (body, b"")
    return body[:at[-1]], body[at[-1] + 1:]


def _lang_seed(lang: str) -> int:
    """A number that keeps languages apart, the same in every task."""
    a = np.frombuffer(lang.encode("utf-8", "surrogatepass"), np.uint8)
    return int(_mixed(np.array([((a.astype(np.uint64) + np.uint64(1)) * _powers(_BASES[1], len(a))).sum(dtype=np.uint64)]))[0])


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], np.ndarray, Words]]:
    """(languages, their seeds, words) for stretch after stretch."""
    for batch in batches:
        coded = batch.column("lang").dictionary_encode()
        names = coded.dictionary.to_pylist()
        seeds = np.array([_lang_seed(n) for n in names], np.uint64)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        texts = batch.column("text")
        for at in range(0, batch.num_rows, 500):
            for words in _readings(texts.slice(at, 500).to_pylist(), codes[at:at + 500]):
                yield names, seeds, words


class Look:
    """A bit table of hashes; finds every hash put into it, and a few others."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.size = bits, (8 * len(bits)).bit_length() - 1

    def __call__(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for place in _places(h, self.size):
            out &= (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0
        return out


def _places(h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    h = h.astype(np.uint64, copy=False) & _BEGINNING
    return h >> np.uint64(64 - size), _mixed(h) >> np.uint64(64 - size)


def look_for(hashes: DataFrame, size: int = TABLE_BITS) -> np.ndarray:
    """The bit table of a column ``h``, put together in blocks; only the finished blocks, fixed in size, come to the driver."""
    block_bits = min(_BLOCK_BITS, size - 3)

    def places(batches):
        for batch in batches:
            at = np.concatenate(_places(batch.column("h").to_numpy().view(np.uint64), size)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((at >> block_bits).astype(np.int32)), pa.array((at & ((1 << block_bits) - 1)).astype(np.int32))], ["block", "bit"])

    def fill(key: tuple, part: pa.Table) -> pa.Table:
        bits = np.zeros(1 << block_bits, bool)
        bits[part.column("bit").to_numpy()] = True
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    spread = hashes.select("h").mapInArrow(places, "block int, bit int")
    out = np.zeros((1 << size) // 8, np.uint8)
    width = (1 << block_bits) // 8
    for block, bits in spread.groupBy("block").applyInArrow(fill, "block int, bits binary").collect():
        out[block * width:(block + 1) * width] = np.frombuffer(bits, np.uint8)
    return out


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers byte by byte of their digits, compressed: high digits are mostly alike."""
    return pa.compress(np.ascontiguousarray(values.astype(np.uint64, copy=False).view(np.uint8).reshape(-1, 8).T), codec="zstd", asbytes=True)


def _unpack(body: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(body, 8 * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, size).T).view(np.uint64).reshape(-1)


def _packed(shard: int, bits: int, names: list[str], code: np.ndarray, key: np.ndarray, n: np.ndarray,
            lengths: np.ndarray | None = None, data: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """One row per range of the keys (by their first ``bits``); the keys themselves go along unless there are strings."""
    part = key >> np.uint64(64 - bits) if bits else np.zeros(len(key), np.uint64)
    order = np.lexsort((key, code, part))
    part, code, key, n = part[order], code[order], key[order], n[order]
    if lengths is not None:
        data = data[_ragged((np.cumsum(lengths) - lengths)[order], lengths[order])]
        lengths = lengths[order]
        places = np.concatenate([[0], np.cumsum(lengths)])
    firsts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])[:len(part)]).tolist()
    rows: list[tuple] = []
    for a, z in zip(firsts, [*firsts[1:], len(part)]):
        runs = np.flatnonzero(np.concatenate([[True], code[a + 1:z] != code[a:z - 1]]))
        langs, sizes = [names[c] for c in code[a:z][runs].tolist()], np.diff(np.append(runs, z - a)).tolist()
        if lengths is None:  # sorted keys as gaps
            what = (_pack(np.diff(key[a:z], prepend=np.uint64(0))), None, None)
        else:
            what = (None, _pack(lengths[a:z]), pa.compress(np.ascontiguousarray(data[places[a]:places[z]]), codec="zstd", asbytes=True))
        rows.append((shard, int(part[a]), langs, sizes, _pack(n[a:z]), *what))
    kinds = [pa.int32(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64()), *[pa.binary()] * 4]
    names_ = ["shard", "part", "langs", "sizes", "n", "h", "lengths", "data"]
    for at in range(0, len(rows), 1_000):
        yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows[at:at + 1_000]), kinds)], names_)


def _unpacked(rows: pa.Table) -> dict[str, list[tuple]]:
    """Language by language the pieces of (hashes or strings, counts) in some packed rows."""
    found: dict[str, list[tuple]] = {}
    for row in rows.to_pylist():
        size = sum(row["sizes"])
        n = _unpack(row["n"], size).view(np.int64)
        if row["h"] is not None:
            what = np.cumsum(_unpack(row["h"], size), dtype=np.uint64)
        else:
            places = np.concatenate([[0], np.cumsum(_unpack(row["lengths"], size))]).astype(np.int32)
            data = pa.decompress(row["data"], int(places[-1]), codec="zstd") if places[-1] else pa.py_buffer(b"")
            what = pa.StringArray.from_buffers(size, pa.py_buffer(places), data)
        at = 0
        for lang, many in zip(row["langs"], row["sizes"]):
            found.setdefault(lang, []).append((what[at:at + many], n[at:at + many]))
            at += many
    return found


def mined(docs: DataFrame, lengths: tuple[int, int], parts: int, bits: int, supports: DataFrame, pairs: np.ndarray | None = None) -> DataFrame:
    """(lang, shard, h, n): counts of hashed phrases of some lengths by shard. With ``pairs``, only phrases all of whose pairs it holds.

    Tasks add up what they read, so the counts are dealt as they are, into ``parts`` that are small enough to be held twice.
    Counts below every language's own support in a shard are left out.
    """
    shipped = None if pairs is None else docs.sparkSession.sparkContext.broadcast(pairs)

    def work(batches):
        look = None if shipped is None else Look(shipped.value)
        shard = None
        held: list[tuple[str, np.ndarray]] = []
        size = 0

        def told():
            names = sorted({name for name, _ in held})
            summed = [np.unique(np.concatenate([x for own, x in held if own == name]), return_counts=True) for name in names]
            if summed:
                yield from _packed(shard, bits, names, np.repeat(np.arange(len(names)), [len(h) for h, _ in summed]), *map(np.concatenate, zip(*summed)))

        for batch in batches:
            # A batch may hold rows of several shards where files were joined into one task.
            several = pc.unique(batch.column("shard")).to_pylist()
            for own in several:
                if shard is not None and own != shard:
                    yield from told()
                    held, size = [], 0
                shard = own
                for names, seeds, words in _batches([batch.filter(pc.equal(batch.column("shard"), own)) if len(several) > 1 else batch]):
                    likely = None
                    for n, at, h in words.hashes(seeds):
                        if n == 2 and look is not None:
                            likely = np.zeros(len(words), bool)
                            likely[at[look(h[at])]] = True
                        if not lengths[0] <= n <= lengths[1]:
                            continue
                        if look is not None:
                            at = at[np.logical_and.reduce([likely[at + k] for k in range(n - 1)])]
                        for code, lang in enumerate(names):
                            mine = at if len(names) == 1 else at[words.lang[at] == code]
                            if len(mine):
                                held.append((lang, h[mine] & _BEGINNING))
                                size += len(mine)
                    if size >= HELD:
                        yield from told()
                        held, size = [], 0
        yield from told()

    def add(rows: pa.Table) -> pa.Table:
        shard, least = rows.column("shard")[0].as_py(), rows.column("least")[0].as_py()
        out = []
        for lang, pieces in _unpacked(rows).items():
            h, n = map(np.concatenate, zip(*pieces))
            order = np.argsort(h, kind="stable")
            h, n = h[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            n = np.add.reduceat(n, first)
            h, n = h[first][n >= least], n[n >= least]
            out.append(pa.table([pa.array([lang], pa.string()).take(pa.array(np.zeros(len(h), np.int64))), pa.array(np.full(len(h), shard, np.int32)),
                                 pa.array(h.view(np.int64)), pa.array(n)], ["lang", "shard", "h", "n"]))
        return pa.concat_tables(out)

    packed = docs.select("lang", "shard", "text").mapInArrow(work, _PACKED).drop("lengths", "data").repartition(parts, "shard", "part")
    lowest = supports.groupBy("shard").agg(F.min("least").alias("least"))
    return joined_small(packed, lowest, "shard").groupBy("shard", "part").applyInArrow(add, "lang string, shard int, h long, n long")


def reachable(counts: DataFrame, supports: DataFrame, support: int) -> DataFrame:
    """(h) of the phrases that are frequent in a shard and can reach the support in all.

    ``supports`` has for each language and shard its own support (``least``) and the sum of what all the language's shards can hide
    (``hidden``: a phrase that is not frequent in a shard stays below that shard's support there).
    """
    frequent = joined_small(counts, supports, ["lang", "shard"]).where("n >= least")
    most = frequent.groupBy("lang", "h").agg(F.sum("n").alias("known"), F.sum(F.col("least") - 1).alias("seen"), F.max("hidden").alias("hidden"))
    return most.where(F.col("known") + F.col("hidden") - F.col("seen") >= support).select("h")


def counted(docs: DataFrame, table: np.ndarray, parts: int, bits: int, support: int) -> DataFrame:
    """(lang, words, phrase, n): exact counts of the phrases that the table may hold, from ``support`` on. A row with 0 words gives the language's word count."""
    shipped = docs.sparkSession.sparkContext.broadcast(table)

    def work(batches):
        look = Look(shipped.value)
        known: dict[str, int] = {}
        totals: dict[str, int] = {}
        held: list[Entries] = []
        size = 0
        for names, seeds, words in _batches(batches):
            code = np.array([known.setdefault(name, len(known)) for name in names], np.int64)
            for name, n in zip(names, np.bincount(words.lang, minlength=len(names)).tolist()):
                totals[name] = totals.get(name, 0) + n
            flat, places = words.spelled()
            for (n, at, h), (_, _, other) in zip(words.hashes(seeds), words.hashes(seeds, 1)):
                at = at[look(h[at])]
                # Two hashes name a phrase within a task; the sums go by its words.
                held.append(Entries.of(code[words.lang[at]], h[at], other[at], flat, places[at], places[at + n] - 1 - places[at]))
                size += len(held[-1])
            if size >= HELD // 8:  # an entry is some times as long as a bare hash
                held = [Entries.joined(held)]
                size = len(held[0])
                if size >= HELD // 16:
                    yield from told(held[0], list(known))
                    held, size = [], 0
        if held:
            yield from told(Entries.joined(held), list(known))
        if totals:  # the words of a language count as its empty phrase
            n = len(totals)
            yield from _packed(0, bits, list(totals), np.arange(n), np.array([_lang_seed(name) for name in totals], np.uint64), np.array(list(totals.values())),
                               np.zeros(n, np.int64), np.zeros(0, np.uint8))

    def told(entries, names):
        yield from _packed(0, bits, names, entries.group, entries.key, entries.n, entries.lengths, entries.data)

    def add(rows: pa.Table) -> pa.Table:
        out = []
        for lang, pieces in _unpacked(rows).items():
            both = pa.table([pa.chunked_array([p for p, _ in pieces]), pa.chunked_array([pa.array(n) for _, n in pieces])], ["phrase", "n"])
            both = both.group_by("phrase", use_threads=False).aggregate([("n", "sum")])
            phrase, n = both.column("phrase"), both.column("n_sum")
            empty = pc.equal(phrase, "")
            words = pc.if_else(empty, 0, pc.add(pc.count_substring(phrase, " "), 1)).cast(pa.int32())
            every = pa.table([pa.array([lang], pa.string()).take(pa.array(np.zeros(len(n), np.int64))), words, phrase, n], ["lang", "words", "phrase", "n"])
            out.append(every.filter(pc.or_(empty, pc.greater_equal(n, support))))
        return pa.concat_tables(out)

    packed = docs.select("lang", "text").mapInArrow(work, _PACKED).drop("shard")
    return packed.repartition(parts, "part").groupBy("part").applyInArrow(add, "lang string, words int, phrase string, n long")


def frequent_phrases(docs: DataFrame, support: int = 30, shards: int = SHARDS, table_bits: int = TABLE_BITS) -> DataFrame:
    """(lang, words, phrase, n) of all phrases of up to four words that occur ``support`` times, and each language's word count (0 words).

    ``docs`` has lang and text; ``table_bits`` (6 at least) is for speed only.
    """
    # Written once, so that a shard is the same in every pass.
    docs = saved(docs.select("lang", "text", F.expr(f"spark_partition_id() % {shards}").alias("shard")), "shards")
    sizes = docs.groupBy("lang", "shard").agg(F.sum(F.octet_length("text") + F.lit(1)).alias("size"))
    whole = sizes.groupBy("lang").agg(F.sum("size").alias("whole"))
    least = sizes.join(whole, "lang").withColumn("least", F.expr(f"({support} * size + whole - 1) div whole"))
    supports = saved(least.join(least.groupBy("lang").agg(F.sum(F.col("least") - 1).alias("hidden")), "lang").select("lang", "shard", "least", "hidden"), "supports")
    read = least.agg(F.sum("size")).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(read // PART_BYTES, MOST_PARTS))
    bits = (read // PART_BYTES // shards).bit_length()
    short = saved(reachable(mined(docs, (1, 2), parts, bits, supports), supports, support), "short")
    table = look_for(short, table_bits)
    long = saved(reachable(mined(docs, (3, LONGEST), parts, bits, supports, table), supports, support), "long")
    return saved(counted(docs, table | look_for(long, table_bits), parts, max(read // PART_BYTES, 1).bit_length() - 1, support), "phrases")


def collocations(docs: DataFrame, support: int = 30, top: int = 2000, inside: int = 80, shards: int = SHARDS, table_bits: int = TABLE_BITS,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The best collocations of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are put in lower case (A-Z) and split at ``. , ; : ! ?`` and line breaks into pieces, pieces at blanks and tabs into words.
    A phrase of 2 to 4 words that occurs a >= ``support`` times is a candidate. Cut after its first k words it scores
    floor(2000000 * a / (l + r)), with l and r the occurrences of both parts; the lowest cut counts, the earliest of equals.
    A candidate whose words stand inside a longer candidate that occurs ``inside`` percent as often goes. ``n`` counts the
    language's words.

    A null text is empty, a null language ``und``. Phrases never cross texts; repeated rows count each time. An empty
    table, or one without a frequent phrase, gives an empty result; other columns are ignored.
    """
    given = columns_of(docs, text=text_col, lang=lang_col)
    given = given.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    found = frequent_phrases(given, support, shards, table_bits)
    words = found.where("words = 0").select("lang", F.col("n").alias("n"))
    phrases = found.where("words > 0").select("lang", "words", "phrase", F.col("n").alias("a"))
    split = phrases.where("words > 1").withColumn("list", F.split("phrase", " "))
    part = lambda start, size: F.array_join(F.slice("list", start, size), " ")

    cuts = split.withColumn("k", F.explode(F.expr("sequence(1, words - 1)"))).select(
        "lang", "phrase", "words", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    known = phrases.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
    cuts = cuts.join(known, ["lang", "left"]).join(known.select("lang", F.col("left").alias("right"), F.col("l").alias("r")), ["lang", "right"])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    score = F.call_function("div", F.lit(2_000_000).cast("decimal(7,0)") * wide("a"), wide("l") + wide("r")).cast("long")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    spans = F.expr("filter(flatten(transform(sequence(2, words - 1), w -> transform(sequence(1, words - w + 1), i -> struct(w as w, i as i)))), s -> true)")
    within = split.where("words > 2").select("lang", "a", "list", F.explode(spans).alias("s")).select(
        "lang", part(F.col("s.i"), F.col("s.w")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = scored.join(within, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * wide("longer") < inside * wide("a"))).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    ranked = ranged_positions(left, ["lang"], [F.desc("score"), F.desc("a"), "phrase"], "place").where(F.col("place") < top)
    return joined_small(ranked, words, "lang").select("lang", (F.col("place") + 1).cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
    WITH pieces AS (SELECT lang, row_number() OVER () AS piece, words FROM (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)) WHERE len(words) > 0),
    spots AS (SELECT lang, words, len(words) AS size, unnest(range(1, len(words) + 1)) AS i FROM pieces),
    grams AS (SELECT lang, w, array_to_string(words[i:i + w - 1], ' ') AS phrase, count(*) AS f
      FROM spots, range(1, 5) t(w) WHERE i + w - 1 <= size GROUP BY ALL HAVING count(*) >= 30),
    n AS (SELECT lang, sum(len(words))::BIGINT AS n FROM pieces GROUP BY lang),
    cand AS (SELECT lang, w, phrase, f AS a, string_split(phrase, ' ') AS list FROM grams WHERE w > 1),
    cuts AS (SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f))::BIGINT AS score
      FROM (SELECT *, unnest(range(1, w)) AS k FROM cand) c JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(list[1:k], ' ')
      JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(list[k + 1:c.w], ' ')),
    best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inner_ AS (SELECT lang, phrase, max(a) AS longer FROM (SELECT lang, a, array_to_string(list[i:i + v - 1], ' ') AS phrase
      FROM cand, range(2, 4) t(v), range(1, 4) u(i) WHERE v < w AND i + v - 1 <= w) GROUP BY ALL),
    kept AS (SELECT best.* FROM best LEFT JOIN inner_ USING (lang, phrase) WHERE longer IS NULL OR 100 * longer::HUGEINT < 80 * a::HUGEINT)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM kept JOIN n USING (lang) QUALIFY rank <= 2000"""
