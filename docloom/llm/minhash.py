"""Near-duplicate documents by MinHash and an LSH forest.

A tree of the forest is the list of all signatures sorted by their own choice of hash
values. Documents that agree in the leading values stand next to each other; how many
they agree in is their common prefix. In each tree a region is a run of documents that
agree in the first ``DEPTH`` values:

- a region of few documents gives all its pairs;
- a larger one is taken deeper, value by value, and its smaller runs give all their pairs;
  throughout it every document is also paired with the next ones in order, so that a group
  of copies of any size stays connected with a number of candidates that is linear in it.

The sorted orders are range partitions with the document id as last key, so a group of
copies, however large, is dealt over many tasks. Where two partitions meet, the last and
the first document are paired too.

Documents with equal shingle sets are one class and enter once. Candidates are confirmed
on full sets. First each document tries its best candidate; later rounds try only pairs
whose documents are not linked yet, since a pair inside a component changes nothing.

Neighbours alone would lose the only link of two documents in a large region whose other
members are alike but below the similarity. So the regions that hold more than one component
when all candidates are tried are open, and the documents of open regions are compared exactly: in tiles of
like set sizes, two of which meet in a task. There two sets that reach the similarity share one of the rarest few shingles
of both; what does is counted out on full sets, and the task returns a forest of links. No pair leaves a task.

With 20 trees and a similarity of exactly 0.8 a pair stands in no common region with
probability (1 - 0.8 ** 4) ** 20 = 2.6e-5; the higher the similarity, the less. Pairs of a
common region are all found, whatever its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import columns_of, components, free_name, saved
from docloom.operators.numbering import ranged_positions

TREES, DEPTH, DEEPEST = 20, 4, 8
SMALL = 12  # documents of a region that gives all its pairs
NEXT = 2  # documents that follow in order, in larger regions
HASHES = TREES * DEPTH
TILE, TILE_SHINGLES = 1024, 1 << 20  # documents of a tile of an open region, and their shingles (about)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_UNODD = np.uint64(pow(int(_ODD), -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """The first n powers of an odd number modulo 2 ** 64; kept, since most texts are of like length."""
    known = _POWERS.get(int(base))
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 14), base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if len(known) <= 1 << 20:
            _POWERS[int(base)] = known
    return known[:n]


def word_hashes(body: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a text whose words are set apart by ASCII blanks."""
    a = np.frombuffer(body, np.uint8)
    blank = (a == 32) | ((a >= 9) & (a <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((a.astype(np.uint64) + np.uint64(1)) * _powers(_ODD, len(a)))])
    # A word's sum divided by the power at its start no longer depends on where it stands.
    return _mixed((sums[ends] - sums[starts]) * _powers(_UNODD, len(a))[starts])


def shingle_set(text: str | None, size: int = 2) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles, A-Z in lower case. Fewer words: one shingle of them all."""
    # Lower-casing and splitting bytes touches ASCII only, which is the rule's alphabet.
    words = word_hashes((text or "").encode("utf-8", "surrogatepass").lower())
    if not len(words):
        return words
    size = min(size, len(words))
    h = np.full(len(words) - size + 1, np.uint64(size), np.uint64)
    for i in range(size):
        h = _mixed(h * _ODD + words[i:len(words) - size + 1 + i])
    return np.unique(h)


def _hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240_501)
    draw = rng.integers(0, 1 << 63, (2, n), dtype=np.uint64)
    return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


_FAMILY = _hash_family(HASHES)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set, as 32 bits."""
    a, b = _FAMILY
    out = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at:at + 4096, None] * a + b
        out = np.minimum(out, (part ^ (part >> np.uint64(32))).min(axis=0))
    return (out >> np.uint64(32)).astype(np.uint32)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list]]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            yield part.column("doc_id"), part.column("text").to_pylist()


def signatures(docs: DataFrame, size: int = 2) -> DataFrame:
    """(doc_id, n_shingles, class, sig): set size, 128 bits that name the set, and its signature."""

    def work(batches):
        for ids, texts in _texts(batches):
            n, names, sigs = [], [], []
            for text in texts:
                s = shingle_set(text, size)
                n.append(len(s))
                with np.errstate(over="ignore"):
                    one, two = _mixed(s), _mixed(s * _ODD + np.uint64(7))
                names.append(np.array([one.sum(dtype=np.uint64), two.sum(dtype=np.uint64)]).tobytes())
                sigs.append(signature(s).astype(">u4").tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(names, pa.binary()), pa.array(sigs, pa.binary())],
                ["doc_id", "n_shingles", "class", "sig"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, n_shingles long, class binary, sig binary")


def full_sets(docs: DataFrame, size: int = 2) -> DataFrame:
    """(doc_id, shingles): the full sets."""

    def work(batches):
        for ids, texts in _texts(batches):
            sets = [shingle_set(t, size).view(np.int64) for t in texts]
            yield pa.RecordBatch.from_arrays([ids, pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "shingles"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, shingles array<long>")


def _large(keys: np.ndarray, tree: np.ndarray) -> np.ndarray:
    """Places of sorted rows in a region of more than ``SMALL`` rows, or in one that may go on beyond the rows."""
    same = (keys[1:, :DEPTH] == keys[:-1, :DEPTH]).all(axis=1) & (tree[1:] == tree[:-1])
    run = np.concatenate([[0], np.cumsum(~same)])
    return np.flatnonzero((np.bincount(run)[run] > SMALL) | (run == 0) | (run == run[-1]))


def _neighbours(keys: np.ndarray, tree: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs (places) of sorted rows: all of a small run, the next ones in a large one."""
    n = len(keys)
    if n < 2:
        return np.zeros(0, int), np.zeros(0, int)
    same = (keys[1:] == keys[:-1]) & (tree[1:] == tree[:-1])[:, None]
    common = np.logical_and.accumulate(same, axis=1).sum(axis=1)  # prefix shared with the row before
    left, right = [], []
    done = np.zeros(n, bool)  # rows whose run has given all its pairs
    for depth in range(DEPTH, DEEPEST + 1):
        run = np.concatenate([[0], np.cumsum(common < depth)])
        size = np.bincount(run)[run]
        small = (size <= SMALL) & (size > 1) & ~done
        for k in range(1, SMALL):
            i = np.flatnonzero(small[:-k] & (run[:-k] == run[k:]))
            left.append(i), right.append(i + k)
        if depth == DEPTH:
            for k in range(1, NEXT + 1):
                i = np.flatnonzero((size > SMALL)[:-k] & (run[:-k] == run[k:])) if n > k else np.zeros(0, int)
                left.append(i), right.append(i + k)
        done |= size <= SMALL
    return np.concatenate(left), np.concatenate(right)


def candidates(sigs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a, b, trees) of documents that are neighbours in the forest, with the number of trees that say so; a < b.
    And (doc_id, tree, prefix) of the documents in regions that need not have given all their pairs."""
    order = [np.concatenate([np.arange(DEPTH * t, DEPTH * (t + 1)), np.arange(DEPTH * (t + 7), DEPTH * (t + 8))]) % HASHES
             for t in range(TREES)]

    def grow(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            table = np.frombuffer(b"".join(batch.column("sig").to_pylist()), ">u4").reshape(-1, HASHES)
            ids = batch.column("doc_id")
            for t, chosen in enumerate(order):
                values = table[:, chosen].astype(np.uint64)
                keys = (values[:, ::2] << np.uint64(32) | values[:, 1::2]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), t, np.int32)), *[pa.array(keys[:, i].copy()) for i in range(4)], ids],
                    ["tree", "k0", "k1", "k2", "k3", "doc_id"])

    kind = sigs.schema["doc_id"].dataType.simpleString()
    rows = sigs.select("doc_id", "sig").mapInArrow(grow, f"tree int, k0 long, k1 long, k2 long, k3 long, doc_id {kind}")
    # Stored, because the range partitions are drawn from a sample of the rows first.
    rows = saved(rows, "forest")
    order_by = ["tree", "k0", "k1", "k2", "k3", "doc_id"]
    sorted_rows = rows.repartitionByRange(*order_by).sortWithinPartitions(*order_by).withColumn("part", F.spark_partition_id())

    def pair(batches):
        # The last rows of a batch are seen again with the next one, so no small run is cut apart.
        held, last = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if last is None:
                yield _edge(batch.slice(0, 1), 0)
            last = batch.slice(batch.num_rows - 1, 1)
            whole = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            yield from _pairs(whole)
            held = whole.slice(max(0, whole.num_rows - 4 * SMALL))
        if last is not None:
            yield _edge(last, 1)

    made = saved(sorted_rows.mapInArrow(pair, f"a {kind}, b {kind}, part int, tree int, prefix string"), "neighbours")
    pairs = made.where("b IS NOT NULL").select("a", "b")
    # Only the first and the last row of each partition: two rows a task.
    edges = made.where("b IS NULL AND part IS NOT NULL")
    regions = made.where("b IS NULL AND part IS NULL").select(F.col("a").alias("doc_id"), "tree", "prefix")
    first = edges.where("part % 2 = 0").select((F.expr("part div 2") - 1).alias("at"), "tree", "prefix", F.col("a").alias("b"))
    last = edges.where("part % 2 = 1").select(F.expr("part div 2").alias("at"), "tree", "prefix", "a")
    across = last.join(first, ["at", "tree", "prefix"]).select("a", "b")
    both = pairs.union(across).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return both.groupBy("a", "b").agg(F.count(F.lit(1)).alias("trees")), regions


def _edge(row: pa.RecordBatch, end: int) -> pa.RecordBatch:
    ids = row.column("doc_id")
    part = 2 * row.column("part")[0].as_py() + end
    prefix = f"{row.column('k0')[0].as_py()}:{row.column('k1')[0].as_py()}"
    return pa.RecordBatch.from_arrays(
        [ids, pa.nulls(1, ids.type), pa.array([part], pa.int32()), row.column("tree"), pa.array([prefix])],
        ["a", "b", "part", "tree", "prefix"])


def _pairs(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    packed = np.stack([rows.column(f"k{i}").to_numpy() for i in range(4)], 1).astype(np.int64)
    keys = np.stack([x for i in range(4) for x in (packed[:, i] >> 32, packed[:, i] & 0xFFFFFFFF)], 1)
    tree = rows.column("tree").to_numpy()
    left, right = _neighbours(keys, tree)
    ids, names = rows.column("doc_id"), ["a", "b", "part", "tree", "prefix"]
    none = pa.nulls(len(left), pa.int32())
    yield pa.RecordBatch.from_arrays(
        [ids.take(pa.array(left)), ids.take(pa.array(right)), none, none, pa.nulls(len(left), pa.string())], names)
    at = _large(keys, tree)
    prefix = pa.array([f"{a}:{b}" for a, b in packed[at, :2].tolist()], pa.string())
    yield pa.RecordBatch.from_arrays(
        [ids.take(pa.array(at)), pa.nulls(len(at), ids.type), pa.nulls(len(at), pa.int32()), pa.array(tree[at], pa.int32()), prefix], names)


def open_documents(regions: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, component, cluster) of the documents in regions that hold more than one component.

    Regions that share a document form a cluster, named by its smallest document; pairs to look for lie within one.
    """
    named = regions.join(found.select(F.col("node").alias("doc_id"), "component_id"), "doc_id", "left")
    named = saved(named.select("doc_id", "tree", "prefix", F.coalesce("component_id", "doc_id").alias("component")), "regions")
    mixed = named.groupBy("tree", "prefix").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.min("doc_id").alias("head")).where("x <> y")
    rows = saved(named.join(mixed.select("tree", "prefix", "head"), ["tree", "prefix"]).select("doc_id", "component", "head").distinct(), "open")
    clusters = components(rows.select(F.col("doc_id").alias("a"), F.col("head").alias("b")))
    return rows.select("doc_id", "component").distinct().join(clusters.select(F.col("node").alias("doc_id"), F.col("component_id").alias("cluster")), "doc_id")


def _set_links(left: pa.Table, right: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Rows (of both tables, end to end) that reach the similarity across the tables, or within one if ``right`` is empty.

    Links inside what is a component already, or has become one here, are left out: they would change nothing. Two sets that
    reach the similarity share one of the rarest few shingles of each; rows that do are counted out on their full sets.
    """
    split, both = left.num_rows, pa.concat_tables([left, right.cast(left.schema)]) if right.num_rows else left
    column = both.column("shingles").combine_chunks()
    sizes = np.diff(column.offsets.to_numpy()).astype(np.int64)
    _, code, often = np.unique(column.flatten().to_numpy(), return_inverse=True, return_counts=True)
    rare = np.empty(len(often), np.int64)
    rare[np.argsort(often, kind="stable")] = np.arange(len(often))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((rare[code], owner))
    code, starts = code[order], np.cumsum(sizes) - sizes
    place = np.arange(len(code)) - starts[owner]
    # A partner shares at least so many of a set's shingles that one of the first is among them.
    first = (place < (sizes - -(-sizes * percent // 100) + 1)[owner]) & (often[code] > 1)
    at = np.flatnonzero(first)[np.argsort(code[first], kind="stable")]
    edges = np.flatnonzero(np.concatenate([[True], np.diff(code[at]) != 0, [True]])) if len(at) else np.zeros(1, int)
    met = np.zeros((split, len(sizes) - split if right.num_rows else split), bool)
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
        rows = owner[at[lo:hi]]
        if right.num_rows:
            met[np.ix_(rows[rows < split], rows[rows >= split] - split)] = True
        else:
            met[np.ix_(rows, rows)] = True
    _, root = np.unique(both.column("component").to_numpy(), return_inverse=True)
    held, links = np.zeros(len(often), bool), []
    for i in np.flatnonzero(met.any(axis=1)).tolist():
        others = np.flatnonzero(met[i]) + (split if right.num_rows else 0)
        if not right.num_rows:
            others = others[others > i]
        others = others[(root[others] != root[i]) & (100 * np.minimum(sizes[others], sizes[i]) >= percent * np.maximum(sizes[others], sizes[i]))]
        if not len(others):
            continue
        own = code[starts[i]:starts[i] + sizes[i]]
        held[own] = True
        for lo in range(0, len(others), 256):
            part = others[lo:lo + 256]
            places = np.concatenate([np.arange(starts[j], starts[j] + sizes[j]) for j in part])
            shared = np.add.reduceat(held[code[places]], np.cumsum(sizes[part]) - sizes[part], dtype=np.int64)
            for j in part[100 * shared >= percent * (sizes[part] + sizes[i] - shared)].tolist():
                if root[i] != root[j]:
                    links.append((i, j))
                    root[root == root[j]] = root[i]
        held[own] = False
    return links


def exact_links(sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that join the components of each cluster as all its pairs at the similarity would.

    ``sets`` has doc_id, component, cluster and shingles. A cluster's documents are cut into tiles by set size, and two tiles
    meet in a task if their sizes can reach the similarity. Pairs are found and tried inside the task; it returns a forest of
    links, fewer than it has documents.
    """
    n = F.size("shingles")
    sets = sets.withColumn("n", n).withColumn("level", F.expr("int(floor(log2(n)))"))
    tile = F.expr(f"place div greatest(1L, least({TILE}L, {TILE_SHINGLES}L div (1L << (level + 1))))")
    tiled = saved(ranged_positions(sets, ["cluster", "level"], ["n", "doc_id"], "place").withColumn("tile", tile).drop("place"), "tiled")
    tiles = tiled.groupBy("cluster", "level", "tile").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    tiles = saved(tiles.withColumn("t", F.row_number().over(Window.partitionBy("cluster").orderBy("level", "tile"))), "tiles")
    one = tiles.select("cluster", F.col("level").alias("level_a"), F.col("tile").alias("tile_a"), F.col("most").alias("most_a"), F.col("t").alias("a"))
    two = tiles.select("cluster", F.col("level").alias("level_b"), F.col("tile").alias("tile_b"), F.col("least").alias("least_b"), F.col("t").alias("b"))
    meet = saved(one.join(two, "cluster").where(f"a <= b AND 100 * most_a >= {percent} * least_b"), "meet")
    carried = ["cluster", "a", "b", "doc_id", "component", "shingles"]
    left = tiled.join(meet.select("cluster", F.col("level_a").alias("level"), F.col("tile_a").alias("tile"), "a", "b"), ["cluster", "level", "tile"])
    right = tiled.join(meet.where("a < b").select("cluster", F.col("level_b").alias("level"), F.col("tile_b").alias("tile"), "a", "b"), ["cluster", "level", "tile"])

    def compare(one: pa.Table, two: pa.Table) -> pa.Table:
        links = _set_links(one, two, percent) if one.num_rows else []
        ids = pa.chunked_array([*one.column("doc_id").chunks, *two.column("doc_id").chunks], one.column("doc_id").type)
        return pa.table({name: ids.take(pa.array([pair[k] for pair in links], pa.int64())) for k, name in enumerate(("a", "b"))})

    kind = sets.schema["doc_id"].dataType.simpleString()
    left, right = (side.select(*[F.col(c).alias(c) for c in carried]) for side in (left, right))  # columns of their own
    return left.groupBy("cluster", "a", "b").cogroup(right.groupBy("cluster", "a", "b")).applyInArrow(compare, f"a {kind}, b {kind}")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach ``100 * intersection >= percent * union``."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    met = pairs.select("a", "b").join(one, "a").join(two, "b")
    shared = F.size(F.array_intersect("x", "y"))
    return met.where(100 * shared >= percent * (F.size("x") + F.size("y") - shared)).select("a", "b")


def near_duplicates(docs: DataFrame, size: int = 2, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable by links), kept (is it itself).

    Two documents are linked if their shingle sets reach the similarity, in percent. A null, empty or blank
    text has no shingles and is linked with nothing. A row with a null id links nothing; it counts as a copy of
    an equal text with an id, else it keeps a null component and stays. Rows that repeat an id stay rows; the links
    of each of their texts count for the id. An empty table gives an empty result; other columns are ignored.
    """
    rows = columns_of(docs, doc_id=id_col, text=text_col)
    sigs = saved(signatures(rows, size), "signatures")
    full = sigs.where("n_shingles > 0 AND doc_id IS NOT NULL")
    heads = full.groupBy("class").agg(F.min("doc_id").alias("head"))
    # The class heads alone are compared; their copies hang on them by the class's name.
    reps = full.join(heads, "class").where(F.col("doc_id") == F.col("head")).select("doc_id", "sig").distinct()
    pairs, regions = candidates(reps)
    pairs = saved(pairs, "candidates")
    best = pairs.groupBy("a").agg(F.max_by("b", F.struct("trees", "b")).alias("b")).union(
        pairs.groupBy("b").agg(F.max_by("a", F.struct("trees", "a")).alias("a")).select("a", "b")).distinct()
    # The texts that need comparing are fetched once for all rounds, by a join that is the same at every size.
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()
    sets = saved(full_sets(rows.join(wanted.hint("merge"), "doc_id", "left_semi"), size), "sets")
    links = saved(confirmed(best, sets, percent), "links")
    found = saved(components(links), "components")
    rest = pairs.select("a", "b").join(found.select(F.col("node").alias("a"), F.col("component_id").alias("ca")), "a", "left")
    rest = rest.join(found.select(F.col("node").alias("b"), F.col("component_id").alias("cb")), "b", "left")
    rest = rest.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    rest = saved(rest.join(best, ["a", "b"], "left_anti"), "rest")
    more = saved(confirmed(rest, sets, percent), "links")
    links = links.union(more)
    found = saved(components(links), "components") if more.limit(1).count() else found
    unsure = saved(open_documents(regions, found), "open")
    if unsure.limit(1).count():
        sets = saved(full_sets(rows.join(unsure.select("doc_id").hint("merge"), "doc_id", "left_semi"), size), "sets")
        more = saved(exact_links(sets.join(unsure, "doc_id"), percent), "links")
        found = saved(components(links.union(more)), "components") if more.limit(1).count() else found
    named = heads.join(found.select(F.col("node").alias("head"), "component_id"), "head", "left").select(
        "class", F.coalesce("component_id", "head").alias("component_id"))
    out = sigs.join(named, "class", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


def keep_first(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group of near copies, the one with the smallest id, with all columns.

    A document is its id: rows with a null id stay, rows that repeat an id stay or go together.
    """
    name = free_name(docs, "_gone")
    gone = near_duplicates(docs, size, percent, id_col, text_col).where(~F.col("kept")).select(F.col("doc_id").alias(name))
    gone = gone.where(F.col(name).isNotNull()).distinct().hint("merge")
    return docs.join(gone, F.col(f"`{id_col}`") == F.col(name), "left_anti")


#: The registered query by its definition: all pairs that share a shingle, and what each document can reach.
ORACLE = r"""
    WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents),
    sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words),
    classes AS (SELECT list_sort(s) AS s, min(doc_id) AS head, len(s) AS n FROM (SELECT * FROM sets WHERE len(s) > 0) GROUP BY ALL),
    each AS (SELECT head, n, unnest(s) AS shingle FROM classes),
    shared AS (SELECT a.head AS a, b.head AS b, a.n AS n, b.n AS m, count(*) AS i FROM each a JOIN each b ON a.shingle = b.shingle AND a.head < b.head
        AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY ALL),
    half AS (SELECT a, b FROM shared WHERE 100 * i >= 80 * (n + m - i)),
    links AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
    reach AS (SELECT head AS a, head AS b FROM classes UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
    found AS (SELECT classes.s, min(b) AS component_id FROM reach JOIN classes ON classes.head = reach.a GROUP BY ALL)
    SELECT doc_id, len(sets.s)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id, doc_id = coalesce(component_id, doc_id) AS kept
    FROM sets LEFT JOIN found ON found.s = list_sort(sets.s)"""
