"""How the term distributions of sources differ, read off a quadtree over the group-term count matrix.

Rows of the matrix are groups (language, source), columns the terms that a language keeps, cells the smoothed share of
the term in the group, in billionths. Shares need nothing but counts: where a group lacks a term its share is the same for
every such term, so two groups price all columns that both lack with one product.

The matrix is dealt in tiles: columns by language and by how often a term occurs, so that rare terms and with them the empty
cells lie together, rows by blocks of groups. Two row blocks meet over a column block in one task. There a K-squared tree
(four children a node) tells which quadrants hold no cell at all. Both groups' trees are walked together: columns where neither has a
cell are left to the price for empty columns, only leaves with cells are priced term by term. A task returns sums by
pair of groups, so no pair of rows is ever spelled out by term.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import columns_of, joined_small, saved
from docloom.llm.entries import Entries, hash_words, strings
from docloom.llm.minhash import _mixed
from docloom.operators.numbering import top_k

#: Cells of a column block (about), groups of a row block (about), and the sides of a leaf of the tree.
BLOCK_CELLS, BLOCK_GROUPS, LEAF_GROUPS, LEAF_TERMS = 4096, 256, 8, 32
#: Bytes of text looked at together, and distinct entries that a task holds before it hands them on.
PIECE_BYTES, HELD = 500_000, 100_000
BILLION = 1_000_000_000
_IN_TERM = np.zeros(256, bool)
_IN_TERM[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column end to end, and where each text begins; one more place for the end."""
    column = column.cast(pa.large_string())
    places = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[places[0]:places[-1]] if data is not None and len(data) else np.zeros(0, np.uint8)
    return flat, places - places[0]


def _terms(a: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with A-Z in lower case, and first and last place (exclusive) of each term; terms end where a text does."""
    a = np.where((a >= 65) & (a <= 90), a + np.uint8(32), a)
    inside = _IN_TERM[a]
    cut = np.zeros(len(a) + 1, bool)
    cut[begins] = cut[-1] = True
    starts = np.flatnonzero(inside & (cut[:-1] | ~np.concatenate([[False], inside[:-1]])))
    ends = np.flatnonzero(inside & (cut[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    return a, starts, ends


def _entries(a: np.ndarray, starts: np.ndarray, ends: np.ndarray, group: np.ndarray, doc: np.ndarray) -> Entries:
    key = _mixed(hash_words(a, starts, ends, 0) ^ _mixed(group.astype(np.uint64) + np.uint64(1)))
    return Entries.of(group, key, hash_words(a, starts, ends, 1), a, starts, ends - starts, doc)


def _document_entries(a: np.ndarray, group: int) -> Entries:
    """Entries of a long document, cut between terms."""
    parts, at = [], 0
    while at < len(a):
        end = min(len(a), at + PIECE_BYTES)
        while end < len(a) and _IN_TERM[a[end - 1]] and _IN_TERM[a[end]]:
            end += 1
        part, starts, ends = _terms(a[at:end], np.zeros(1, int))
        parts.append(_entries(part, starts, ends, np.full(len(starts), group), np.zeros(len(starts), np.int64)))
        at = end
    return Entries.joined(parts, one_document=True)


def _counted(text: pa.Array, group: np.ndarray) -> Iterator[Entries]:
    """Entries of some texts, a stretch of whole texts at a time."""
    flat, places = _flat(text)
    at = 0
    while at < len(text):
        to = max(at + 1, int(np.searchsorted(places, places[at] + PIECE_BYTES, "right")) - 1)
        part, begins = flat[places[at]:places[to]], places[at:to] - places[at]
        if len(part) > PIECE_BYTES:
            yield _document_entries(part, int(group[at]))
        elif len(part):
            part, starts, ends = _terms(part, begins)
            doc = np.searchsorted(begins, starts, "right") - 1
            yield _entries(part, starts, ends, group[at:to][doc], doc)
        at = to


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in each group, and how many of its documents hold it.

    Each task adds up what it reads, in bounded memory; a row without a term stands for each group it met.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[tuple[str, str], int] = {}
        held: list[Entries] = []
        size = 0
        for batch in batches:
            pairs = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist()))
            group = np.array([names.setdefault(p, len(names)) for p in pairs], np.int64)
            for entries in _counted(batch.column("text"), group):
                held.append(entries)
                size += len(entries)
                if size >= 2 * HELD:
                    held = [Entries.joined(held)]
                    size = len(held[0])
                    if size >= HELD:
                        yield from told(held[0], names)
                        held, size = [], 0
        if held:
            yield from told(Entries.joined(held), names)
        if names:
            langs, sources = zip(*names)
            none = pa.array([0] * len(names), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(sources, pa.string()), pa.nulls(len(names), pa.string()), none, none],
                                             ["lang", "source", "term", "n", "docs"])

    def told(entries: Entries, names: dict) -> Iterator[pa.RecordBatch]:
        langs, sources = (pa.array(x, pa.string()) for x in zip(*names))
        for part, term in strings(entries):
            of = pa.array(entries.group[part])
            yield pa.RecordBatch.from_arrays([langs.take(of), sources.take(of), term, pa.array(entries.n[part]), pa.array(entries.docs[part])],
                                             ["lang", "source", "term", "n", "docs"])

    counted = docs.select("lang", "source", "text").mapInArrow(work, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(billion * (n + 2) / (total + 2 * terms)), exact."""
    wide = lambda c: c.cast("decimal(19,0)")
    over = (wide(n) + F.lit(2).cast("decimal(10,0)")) * F.lit(BILLION).cast("decimal(10,0)")
    return F.call_function("div", over, wide(total + 2 * terms)).cast("long") + 1


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q) ** 2 / (p + q)); shares are at most 1e9 + 1, so squares stay within 63 bits."""
    gap = p - q
    return gap * gap // (p + q)


class Quadtree:
    """Which quadrants of a matrix of shares hold cells; cells without a count are 0."""

    def __init__(self, cells: np.ndarray):
        rows, cols = cells.shape
        self.deep, self.wide = -(-rows // LEAF_GROUPS), -(-cols // LEAF_TERMS)  # leaves that lie within the matrix
        n = max(self.deep, self.wide, 1)
        side = 1 << (n - 1).bit_length()
        full = np.zeros((side * LEAF_GROUPS, side * LEAF_TERMS), bool)
        full[:rows, :cols] = cells > 0
        # Level 0 are the leaves; each level above joins two by two.
        self.levels = [full.reshape(side, LEAF_GROUPS, side, LEAF_TERMS).any(axis=(1, 3))]
        while len(self.levels[-1]) > 1:
            half = len(self.levels[-1]) // 2
            self.levels.append(self.levels[-1].reshape(half, 2, half, 2).any(axis=(1, 3)))


def met_leaves(one: Quadtree, two: Quadtree) -> Iterator[tuple[int, int, int]]:
    """(row leaf of one, row leaf of two, column leaf) wherever either has a cell; both trees are walked together."""
    depth = max(len(one.levels), len(two.levels)) - 1
    stack = [(depth, 0, 0, 0)]
    while stack:
        level, a, b, c = stack.pop()
        if a << level >= one.deep or b << level >= two.deep or c << level >= one.wide:
            continue  # beyond the matrix

        def holds(tree, row):
            if level >= len(tree.levels):  # a smaller tree fills the first quadrant of the larger one's space
                return row == 0 and c == 0 and bool(tree.levels[-1][0, 0])
            here = tree.levels[level]
            return row < len(here) and c < len(here) and bool(here[row, c])

        if not (holds(one, a) or holds(two, b)):
            continue
        if not level:
            yield a, b, c
            continue
        stack += [(level - 1, 2 * a + i, 2 * b + j, 2 * c + k) for i in (0, 1) for j in (0, 1) for k in (0, 1)]


def pair_sums(one: np.ndarray, two: np.ndarray, empty_one: np.ndarray, empty_two: np.ndarray) -> np.ndarray:
    """Sum of prices over all columns for each row of one with each row of two; ``empty_*`` are the rows' shares of absent terms.

    Quadrants without a cell are priced at once by their width.
    """
    rows, others, cols = len(one), len(two), one.shape[1]
    none = price(empty_one[:, None], empty_two[None, :])
    out = none * cols
    for a, b, c in met_leaves(Quadtree(one), Quadtree(two)):
        i, j = slice(a * LEAF_GROUPS, min(rows, (a + 1) * LEAF_GROUPS)), slice(b * LEAF_GROUPS, min(others, (b + 1) * LEAF_GROUPS))
        k = slice(c * LEAF_TERMS, min(cols, (c + 1) * LEAF_TERMS))
        p, q = one[i, k], two[j, k]
        p, q = np.where(p > 0, p, empty_one[i, None]), np.where(q > 0, q, empty_two[j, None])
        out[i, j] += price(p[:, None, :], q[None, :, :]).sum(axis=2) - none[i, j] * p.shape[1]
    return out


def _block_sums(block: pa.Table) -> pa.Table:
    """Sums by pair of groups over one column block. Rows without a term give each group's share of absent terms."""
    lang = block.column("lang")[0]
    first, second = block.column("first")[0].as_py(), block.column("second")[0].as_py()
    groups = block.filter(pc.is_null(block.column("term")))
    cells = block.filter(pc.is_valid(block.column("term")))
    # Common terms first and full groups first, so that the empty quadrants lie together.
    codes = cells.column("term").combine_chunks().dictionary_encode()
    column = codes.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(-np.bincount(column, minlength=len(codes.dictionary)), kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    sides, matrices, empties = {}, {}, {}
    for tile in {first, second}:
        mine = groups.filter(pc.equal(groups.column("tile"), tile))
        sources = mine.column("source").combine_chunks()
        held = cells.filter(pc.equal(cells.column("tile"), tile))
        row = pc.index_in(held.column("source").combine_chunks(), value_set=sources).to_numpy(zero_copy_only=False).astype(np.int64)
        full = np.argsort(-np.bincount(row, minlength=len(sources)), kind="stable")
        back = np.empty(len(full), np.int64)
        back[full] = np.arange(len(full))
        matrix = np.zeros((len(sources), len(order)), np.int64)
        at = pc.index_in(held.column("term").combine_chunks(), value_set=codes.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)
        matrix[back[row], place[at]] = held.column("p").to_numpy()
        sides[tile], matrices[tile] = sources.take(pa.array(full)), matrix
        empties[tile] = mine.column("p").to_numpy()[full]
    sums = pair_sums(matrices[first], matrices[second], empties[first], empties[second])
    i, j = np.nonzero(np.triu(np.ones_like(sums), 1) if first == second else np.ones_like(sums))
    return pa.table({"lang": pa.array([lang.as_py()] * len(i), pa.string()), "source": sides[first].take(pa.array(i)),
                     "item": sides[second].take(pa.array(j)), "value": pa.array(sums[i, j], pa.int64())})


def audit(docs: DataFrame, least_docs: int = 10, top_terms: int = 10, text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """Distances between the sources of each language, and the terms that set each source apart.

    Returns lang, source, part, item, value, rank. Part ``pair``: every other source of the language, by falling distance (the sum of
    prices over the kept terms). Part ``term``: the ``top_terms`` terms that the source uses and uses more than its language
    does, by falling price. A language keeps the terms that at least ``least_docs`` of its documents hold. Ties go by item.

    Null texts, languages and sources count as empty strings, so a null and an empty source are one group. A group without
    terms still has its distances; a language without kept terms has distances of 0; a language with one source has no pairs.
    Repeated rows count each time. An empty table gives an empty result; other columns are ignored.
    """
    given = columns_of(docs, text=text_col, lang=lang_col, source=source_col)
    given = given.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in given.columns])
    counts = saved(count_terms(given), "term-counts")
    terms = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs"))
    terms = saved(terms.where(F.col("docs") >= least_docs).select("lang", "term", "in_lang", F.expr("int(floor(log2(in_lang)))").alias("level")), "kept-terms")
    cells = saved(counts.where("term IS NOT NULL").select("lang", "source", "term", "n").join(terms, ["lang", "term"]), "term-cells")

    langs = terms.groupBy("lang").agg(F.sum("in_lang").alias("lang_total"), F.count(F.lit(1)).alias("terms"))
    held = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.where("term IS NULL").select("lang", "source").join(held, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
    tiles = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("groups")).select("lang", "groups", F.expr(f"int(ceil(groups / {BLOCK_GROUPS}))").alias("tiles"))
    groups = saved(joined_small(groups, tiles, "lang").withColumn("tile", F.expr("int(pmod(xxhash64(source), tiles))")), "groups")

    shares = joined_small(cells, groups, ["lang", "source"]).select(
        "lang", "source", "term", "in_lang", "level", "n", "tile", "tiles", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        share(F.col("in_lang"), F.col("lang_total"), F.col("terms")).alias("q"))
    shares = saved(shares, "shares")

    # Column blocks: terms of one language that occur about equally often, dealt by hash into blocks of about the same size.
    parts = cells.groupBy("lang", "level").agg(F.count(F.lit(1)).alias("of")).join(tiles.select("lang", "groups"), "lang")
    parts = parts.select("lang", "level", F.expr(f"int(ceil(of / greatest({BLOCK_CELLS}, 4 * groups)))").alias("parts"))
    blocked = joined_small(shares, parts, ["lang", "level"]).select(
        "lang", "level", F.expr("int(pmod(xxhash64(term), parts))").alias("part"), "source", "term", "tile", "tiles", "p")
    frames = joined_small(parts, groups, "lang").select(  # every group stands in every block, with its share of absent terms
        "lang", "level", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), "source", F.lit(None).cast("string").alias("term"), "tile", "tiles",
        share(F.lit(0), F.col("total"), F.col("terms")).alias("p"))
    meeting = blocked.unionByName(frames).withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)"))).select(
        "lang", "level", "part", F.least("tile", "other").alias("first"), F.greatest("tile", "other").alias("second"), "tile", "source", "term", "p")
    sums = meeting.groupBy("lang", "level", "part", "first", "second").applyInArrow(_block_sums, "lang string, source string, item string, value long")
    # Each block has its own order of groups.
    sums = sums.groupBy("lang", F.least("source", "item").alias("source"), F.greatest("source", "item").alias("item")).agg(F.sum("value").alias("value"))
    both = sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    bare = groups.where("terms = 0")
    bare = bare.select("lang", "source").join(bare.select("lang", F.col("source").alias("item")), "lang").where("source <> item").withColumn("value", F.lit(0).cast("long"))
    far = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = both.unionByName(bare).withColumn("rank", F.row_number().over(far)).withColumn("part", F.lit("pair"))

    above = F.expr("((p - q) * (p - q)) div (p + q)")
    marked = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), above.alias("value"))
    marked = top_k(marked, ["lang", "source"], [F.desc("value"), "item"], top_terms).withColumn("part", F.lit("term"))
    names = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*names).union(marked.select(*names))


ORACLE = r"""
    WITH docs AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
    groups AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
    kept AS (SELECT lang, term, count(*) AS in_lang FROM docs GROUP BY ALL HAVING count(DISTINCT doc_id) >= 10),
    langs AS (SELECT lang, sum(in_lang)::HUGEINT AS total, count(*) AS v FROM kept GROUP BY lang),
    cells AS (SELECT lang, source, term, count(*) AS n FROM docs SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    totals AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM groups LEFT JOIN cells USING (lang, source) GROUP BY ALL),
    p AS (SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // (totals.total + 2 * v) AS p,
        1 + (1000000000::HUGEINT * (in_lang + 2)) // (langs.total + 2 * v) AS q
      FROM totals JOIN langs USING (lang) JOIN kept USING (lang) LEFT JOIN cells USING (lang, source, term)),
    pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
      FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND item = b.source
      UNION ALL SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q)
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM every
    QUALIFY part = 'pair' OR rank <= 10"""
