"""Nearest neighbours over vector tables: by scan, by block join, and through a metric index.

A few queries, counted, travel with the tasks of one scan of the vectors. More are met in tiles: both sides
are dealt into blocks, and a task holds one block of each. Either way tasks return their best k only, under
thresholds that fall as they read, so what a task holds does not grow with the number of groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from docloom.operators.numbering import top_k
from docloom.session import written

# Queries that travel with the tasks of one scan (2048 x 64 floats = 1 MB); more are met in tiles.
BLOCK_QUERIES = 2_048
# Rows of a tile of either side, and hits that a task holds.
TILE_QUERIES, TILE_VECTORS, HEAP = 32_768, 16_384, 4_000_000
# Hit rows up to this count are broadcast to the table that holds their content.
BROADCAST_HITS = 100_000
SCORE_DIGITS = 9
ROWS_AT_ONCE = 2_048
_COUNT_FIRST = object()


def squared_l2(a: str, b: str, dim: int) -> Column:
    """Squared distance of two vectors, rounded so that equal distances tie exactly.

    Written out per dimension, it compiles into the surrounding stage; a lambda
    over the arrays would be interpreted for every pair.
    """
    gaps = [f"(double({a}[{i}]) - double({b}[{i}]))" for i in range(dim)]
    return F.expr(f"round({' + '.join(f'{g} * {g}' for g in gaps)}, {SCORE_DIGITS})")


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    if len(lengths) and (lengths != lengths[0]).any():
        raise ValueError(f"vectors of different lengths in one table: {sorted(set(lengths.tolist()))}")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _nearest(queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the exact k best per query with a score up to ``most``, in order.

    A matrix product narrows the rows down, the subtraction form decides.
    """
    qq = (queries * queries).sum(axis=1)
    vv = (vectors * vectors).sum(axis=1)
    rough = qq[:, None] + vv[None, :] - 2.0 * (queries @ vectors.T)
    slack = 10.0**-SCORE_DIGITS + 1e-12 * (qq.max(initial=0.0) + vv.max(initial=0.0))
    take = min(k, len(ids)) - 1
    bound = np.minimum(np.partition(rough, take, axis=1)[:, take], most) + 2 * slack
    q, near = np.nonzero(rough <= bound[:, None])
    score = np.empty(len(q))
    for lo in range(0, len(q), ROWS_AT_ONCE * 16):
        part = slice(lo, lo + ROWS_AT_ONCE * 16)
        gap = vectors[near[part]] - queries[q[part]]
        score[part] = np.round((gap * gap).sum(axis=1), SCORE_DIGITS)
    close = score <= most[q]
    q, near, score = q[close], near[close], score[close]
    best = _first_k(q, score, ids[near], k)
    return q[best], near[best], score[best]


def _first_k(q: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best, by query, score and id."""
    order = np.lexsort((ids, score, q))
    mine = q[order]
    first = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]])[:len(mine)])
    rank = np.arange(len(mine)) - np.repeat(first, np.diff(np.append(first, len(mine))))
    return order[rank < k]


class _Best:
    """The k best rows seen so far per (group, query) of one task.

    A query's k-th best score is the threshold for later rows of the group. The hits held are bounded: beyond
    ``HEAP`` they are handed on, and only the thresholds stay, as far as they fit in as much again.
    """

    def __init__(self, k: int, queries: np.ndarray, most: np.ndarray | None = None):
        self.k, self.queries, self.size = k, queries, 0
        self.most = np.full(len(queries), np.inf) if most is None else most
        self.kept: dict[object, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.kth: dict[object, np.ndarray] = {}

    def scan(self, vectors: np.ndarray, ids: np.ndarray, groups: np.ndarray) -> None:
        for lo in range(0, len(ids), ROWS_AT_ONCE):
            part = slice(lo, lo + ROWS_AT_ONCE)
            codes = pd.factorize(groups[part], use_na_sentinel=False)[0]
            order = np.argsort(codes, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(codes[order])) + 1):
                self._add(groups[part][rows[0]], vectors[part][rows], ids[part][rows])

    def _add(self, group, vectors: np.ndarray, ids: np.ndarray) -> None:
        kth = self.kth.setdefault(group, self.most.copy())
        q, near, score = _nearest(self.queries, vectors, ids, self.k, kth)
        if not len(q):
            return
        ids = ids[near]
        if group in self.kept:
            old = self.kept[group]
            self.size -= len(old[0])
            q, ids, score = (np.concatenate(x) for x in zip(old, (q, ids, score)))
            best = _first_k(q, score, ids, self.k)
            q, ids, score = q[best], ids[best], score[best]
        self.kept[group] = (q, ids, score)
        self.size += len(q)
        last = np.flatnonzero(q[self.k - 1:] == q[:len(q) - self.k + 1]) + self.k - 1 if len(q) >= self.k else np.zeros(0, int)
        kth[q[last]] = np.minimum(kth[q[last]], score[last])

    @property
    def full(self) -> bool:
        return self.size > HEAP or len(self.kth) * len(self.queries) > HEAP

    def taken(self, labels: pa.Array, schema: T.StructType) -> pa.RecordBatch:
        """The hits held, which are let go."""
        types = [to_arrow_type(f.dataType) for f in schema.fields]
        names, held = list(self.kept), list(self.kept.values())
        self.kept, self.size = {}, 0
        if len(self.kth) * len(self.queries) > HEAP:
            self.kth = {}
        if not held:
            return pa.RecordBatch.from_arrays([pa.array([], t) for t in types], names=schema.names)
        q, ids, scores = (np.concatenate(x) for x in zip(*held))
        of = np.repeat(np.arange(len(names)), [len(h[0]) for h in held])
        columns = [labels.take(pa.array(q)).cast(types[0])] + ([pa.array(names, types[1]).take(pa.array(of))] if len(types) == 4 else [])
        columns += [pa.array(ids if ids.dtype.kind != "U" else ids.astype(object), types[-2]), pa.array(scores, types[-1])]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)


def _ids_array(values: pa.Array) -> np.ndarray:
    if pa.types.is_string(values.type) or pa.types.is_large_string(values.type):
        return np.asarray(values.to_pylist(), dtype=np.str_)
    return values.to_numpy(zero_copy_only=False)


def _groups_array(batch, group: str | None) -> np.ndarray:
    return np.asarray(batch.column(group).to_pylist(), dtype=object) if group else np.zeros(batch.num_rows, dtype=np.int8)


def few_queries(queries: DataFrame, query_id: str, vector: str) -> list | None:
    """The query rows if one block holds them all, else nothing; at most ``BLOCK_QUERIES`` + 1 rows reach the driver.

    Queries without a vector find nothing and are left out.
    """
    rows = queries.where(F.col(vector).isNotNull()).select(query_id, vector).limit(BLOCK_QUERIES + 1).collect()
    return rows if len(rows) <= BLOCK_QUERIES else None


def _hit_schema(queries: DataFrame, vectors: DataFrame, query_id: str, vector_id: str, group: str | None):
    fields = [T.StructField(query_id, queries.schema[query_id].dataType)]
    if group:
        fields.append(T.StructField(group, vectors.schema[group].dataType))
    fields += [T.StructField(vector_id, vectors.schema[vector_id].dataType),
               T.StructField("score", T.DoubleType())]
    return T.StructType(fields)


def _scan(rows: list, queries, vectors, query_id, vector_id, vector, group, k) -> DataFrame:
    """One pass over the vectors where they lie; the few queries travel with the tasks."""
    schema = _hit_schema(queries, vectors, query_id, vector_id, group)
    kind = to_arrow_type(schema.fields[0].dataType)
    shipped = vectors.sparkSession.sparkContext.broadcast(([r[0] for r in rows], np.asarray([r[1] for r in rows], dtype=np.float64)))

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, asked = shipped.value
        labels = pa.array(labels, kind)
        best = _Best(k, asked)
        for batch in parts:
            if not len(batch) or not len(labels):
                continue
            best.scan(_matrix(batch.column(vector)), _ids_array(batch.column(vector_id)), _groups_array(batch, group))
            if best.full:
                yield best.taken(labels, schema)
        yield best.taken(labels, schema)

    return vectors.select(vector_id, vector, *([group] if group else [])).mapInArrow(scan, schema)


def _met(asked: DataFrame, filed: DataFrame, keys: Sequence[str], query_id, vector_id, vector, group, k, limit: str | None = None) -> DataFrame:
    """The k best of each block of vectors for each query that meets it; both sides carry the block's keys.

    ``limit`` names a column with a score beyond which a query wants nothing.
    """
    schema = _hit_schema(asked, filed, query_id, vector_id, group)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], to_arrow_type(f.dataType)) for f in schema.fields], names=schema.names)
        most = left.column(limit).to_numpy().copy() if limit else None
        best = _Best(k, _matrix(left.column("_qv")), most)
        best.scan(_matrix(right.column(vector)), _ids_array(right.column(vector_id).combine_chunks()), _groups_array(right, group))
        return pa.Table.from_batches([best.taken(left.column(query_id).combine_chunks(), schema)])

    left = asked.select(*keys, query_id, F.col(vector).alias("_qv"), *([limit] if limit else []))
    right = filed.select(*keys, vector_id, vector, *([group] if group else []))
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, schema)


def _block_join(queries, vectors, query_id, vector_id, vector, group, k) -> DataFrame:
    """Every block of queries meets every block of vectors in a task of its own.

    Blocks are dealt by a hash of the id. Hits of a task are at most queries x groups x k of its blocks, so with
    many groups the blocks of queries are smaller.
    """
    rows = vectors.agg(F.count(F.lit(1)), *([F.approx_count_distinct(group)] if group else [])).first()
    groups = min(TILE_VECTORS, 2 * rows[1]) if group else 1
    wide = max(1, min(TILE_QUERIES, HEAP // (k * max(1, groups))))
    down, across = -(-queries.count() // wide) or 1, -(-rows[0] // TILE_VECTORS) or 1
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = queries.select(deal(query_id, down).alias("_down"), query_id, vector, every(across).alias("_across"))
    filed = vectors.select(deal(vector_id, across).alias("_across"), vector_id, vector, *([group] if group else []), every(down).alias("_down"))
    return _met(asked, filed, ["_down", "_across"], query_id, vector_id, vector, group, k)


def knn(
    queries: DataFrame,
    vectors: DataFrame,
    k: int,
    query_id: str = "query_id",
    vector_id: str = "vec_id",
    vector: str = "embedding",
    group: str | None = None,
    few=_COUNT_FIRST,
) -> DataFrame:
    """Exact k nearest vectors per query (and per ``group`` value), squared L2, ties by id.

    Rows without a vector are never found. ``few`` takes the result of :func:`few_queries` when the caller has it.
    """
    few = few_queries(queries, query_id, vector) if few is _COUNT_FIRST else few
    there = vectors.where(F.col(vector).isNotNull())
    if few is not None:
        local = _scan(few, queries, there, query_id, vector_id, vector, group, k)
    else:
        local = _block_join(queries.where(F.col(vector).isNotNull()), there, query_id, vector_id, vector, group, k)
    return top_k(local, [query_id] + ([group] if group else []), ["score", vector_id], k)


def with_payload(hits: DataFrame, table: DataFrame, key: str, most: int | None) -> DataFrame:
    """Attach content to hits; ``most`` bounds their number, and few enough are broadcast to the content."""
    side = F.broadcast(hits) if most is not None and most <= BROADCAST_HITS else hits
    return table.join(side, key)


def hits_at_most(few: list | None, per_query: int) -> int | None:
    """A bound on the hits of the queries, if they are few."""
    return None if few is None else per_query * len(few)


# --- metric index ----------------------------------------------------------------------

# Pivots grow with the square root of the rows up to this many (1024 x 64 doubles = 512 KB); shells around each.
MOST_PIVOTS, MOST_SHELLS, SHELL_ROWS = 1_024, 16, 64
_CELL = ["pivot", "shell", "slice"]


@dataclass
class MetricIndex:
    """Vectors filed under their nearest pivot and their distance from it.

    ``table`` has the vectors with pivot, shell (rings of equal width around a pivot) and slice (parts of a crowded shell).
    ``cells`` has one row per (pivot, shell): its rows, slices, least and greatest distance; at most
    ``MOST_PIVOTS`` x ``MOST_SHELLS`` rows.
    """

    table: DataFrame
    pivots: np.ndarray
    cells: np.ndarray  # pivot, shell, rows, slices, near, far
    vector_id: str
    vector: str


def _lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances by subtraction, a block of rows at a time."""
    return np.concatenate([np.sqrt(((a[lo:lo + 64, None, :] - b[None, :, :]) ** 2).sum(axis=2)) for lo in range(0, len(a), 64)] or [np.zeros((0, len(b)))])


def build_index(vectors: DataFrame, vector_id: str = "vec_id", vector: str = "embedding", pivots: int | None = None) -> MetricIndex:
    """File every vector under the nearest of some pivots.

    The pivots are a bounded sample: as many rows as the square root of their number, at most ``MOST_PIVOTS``, with the least
    hashes of their ids. Rows without a vector are left out. The index is a table in the shared folder.
    """
    there = vectors.where(F.col(vector).isNotNull()).select(vector_id, vector)
    rows = there.count()
    wanted = pivots or min(MOST_PIVOTS, max(1, math.isqrt(rows)))
    drawn = there.orderBy(F.xxhash64(vector_id), vector_id).limit(wanted).collect()
    points = np.asarray([r[1] for r in drawn], dtype=np.float64)
    shipped = there.sparkSession.sparkContext.broadcast(points)
    shells = max(1, min(MOST_SHELLS, rows // max(1, len(points) * SHELL_ROWS)))
    kinds = there.schema

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                gaps = _lengths(_matrix(batch.column(1)), shipped.value)
                pivot = gaps.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot.astype(np.int32)), pa.array(gaps[np.arange(len(gaps)), pivot])],
                                                 [*kinds.names, "pivot", "away"])

    filed = written(there.mapInArrow(file, T.StructType([*kinds.fields, T.StructField("pivot", T.IntegerType()), T.StructField("away", T.DoubleType())])), "filed")
    widest = filed.agg(F.max("away")).first()[0] or 0.0
    shell = F.least(F.lit(shells - 1), F.floor(F.col("away") * F.lit(shells / widest if widest else 0.0))).cast("int")
    filed = filed.withColumn("shell", shell)
    cells = filed.groupBy("pivot", "shell").agg(F.count(F.lit(1)).alias("rows"), F.min("away").alias("near"), F.max("away").alias("far"))
    cells = cells.withColumn("slices", F.expr(f"int(ceil(rows / {TILE_VECTORS}))")).select("pivot", "shell", "rows", "slices", "near", "far").collect()
    kept = np.array(sorted(map(tuple, cells)), dtype=np.float64).reshape(-1, 6)
    sliced = filed.join(F.broadcast(filed.sparkSession.createDataFrame(
        [(int(c[0]), int(c[1]), int(c[3])) for c in kept], "pivot int, shell int, slices int")), ["pivot", "shell"])
    slice_ = F.pmod(F.xxhash64(vector_id), F.col("slices")).cast("int").alias("slice")
    table = written(sliced.select("pivot", "shell", slice_, vector_id, vector).repartition("pivot", "shell", "slice"), "index")
    return MetricIndex(table, points, kept, vector_id, vector)


def probes(queries: DataFrame, index: MetricIndex, k: int, query_id: str = "query_id", limit: str | None = None) -> DataFrame:
    """The cells that each query looks into: query_id, vector, pivot, shell, slice, rows of the cell, and ``limit``.

    Without a limit: the nearest cells, in order of the least distance they can hold, until they have 4 k rows. With one (a
    squared distance that k rows are known to keep): all other cells that the triangle inequality does not rule out.
    """
    shipped = queries.sparkSession.sparkContext.broadcast((index.pivots, index.cells))
    given = queries.where(F.col(index.vector).isNotNull()).select(query_id, index.vector, *([limit] if limit else []))
    fields = given.schema.fields

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, cells = shipped.value
        for batch in batches:
            if not batch.num_rows or not len(cells):
                continue
            away = _lengths(_matrix(batch.column(1)), pivots)
            own, nearest = away[:, cells[:, 0].astype(int)], away.min(axis=1)
            # No row of a cell is nearer than this: by its ring, and because its pivot is the one next to it.
            least = np.maximum.reduce([own - cells[None, :, 5], cells[None, :, 4] - own, (own - nearest[:, None]) / 2, np.zeros_like(own)])
            order = np.argsort(least, axis=1, kind="stable")
            before = np.cumsum(cells[order, 2], axis=1) - cells[order, 2]
            first = np.zeros(least.shape, bool)
            np.put_along_axis(first, order, before < 4 * k, axis=1)
            if limit:
                # The limit is a rounded square; the allowance covers its rounding and that of the distances.
                reach = np.sqrt(batch.column(2).to_numpy() + 10.0**-SCORE_DIGITS) + 1e-9
                first = ~first & (least <= reach[:, None])
            q, c = np.nonzero(first)
            times = cells[c, 3].astype(int)
            part = np.concatenate([np.arange(n) for n in times]) if len(times) else np.zeros(0)
            q, c = np.repeat(q, times), np.repeat(c, times)
            yield pa.RecordBatch.from_arrays(
                [*(col.take(pa.array(q)) for col in batch.columns), *(pa.array(x.astype(np.int32)) for x in (cells[c, 0], cells[c, 1], part)),
                 pa.array(np.where(part == 0, cells[c, 2], 0).astype(np.int64))], [*(f.name for f in fields), "pivot", "shell", "slice", "rows"])

    added = [T.StructField(n, T.IntegerType()) for n in ("pivot", "shell", "slice")] + [T.StructField("rows", T.LongType())]
    return given.mapInArrow(look, T.StructType([*fields, *added]))


def _first_look(queries: DataFrame, index: MetricIndex, k: int, query_id: str) -> tuple[DataFrame, DataFrame]:
    """Hits in the nearest cells, and the queries with the score that their k-th hit sets as a limit."""
    near = written(_met(probes(queries, index, k, query_id), index.table, _CELL, query_id, index.vector_id, index.vector, None, k), "near")
    far = top_k(near, [query_id], ["score", index.vector_id], k).where(F.col("rank") == k).select(
        F.col(query_id).alias("_known"), F.col("score").alias("_limit"))
    known = queries.select(query_id, index.vector).join(far, F.col(query_id).eqNullSafe(F.col("_known")), "left").select(
        query_id, index.vector, F.coalesce("_limit", F.lit(float("inf"))).alias("_limit"))
    return near, known


def knn_indexed(queries: DataFrame, index: MetricIndex, k: int, query_id: str = "query_id") -> DataFrame:
    """The k nearest vectors per query through the index: the same rows as :func:`knn`, with fewer vectors looked at.

    The nearest cells give each query k rows and with them a distance that the answer keeps; what the triangle
    inequality cannot rule out under it is looked at next. So nothing near is missed, whatever the data; what is saved depends on
    how the vectors cluster.
    """
    near, known = _first_look(queries, index, k, query_id)
    rest = _met(probes(known, index, k, query_id, "_limit"), index.table, _CELL, query_id, index.vector_id, index.vector, None, k, "_limit")
    return top_k(near.union(rest), [query_id], ["score", index.vector_id], k)


def looked_at(queries: DataFrame, index: MetricIndex, k: int, query_id: str = "query_id") -> int:
    """The (query, vector) pairs that a search compares, for reports and tests."""
    known = _first_look(queries, index, k, query_id)[1]
    both = probes(queries, index, k, query_id).select("rows").union(probes(known, index, k, query_id, "_limit").select("rows"))
    return both.agg(F.sum("rows")).first()[0] or 0
