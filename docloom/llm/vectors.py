"""Near-duplicate vectors by PCA-ordered, tiled comparison.

Vectors are turned so that their leading components hold most of the variance, ordered by
the first of them and cut into tiles of bounded size. Two tiles meet in one task unless
their first components lie too far apart. Inside a task the leading components are
multiplied first; the rest of a product is at most the product of the two remaining
norms, so most pairs are given up early. What is left gains further components step by
step, and its cosine is computed in double precision at the end.

A task returns no pairs: it returns the number of links of each vector and a forest that
connects what its links connect, both linear in the tile. So a group of near copies of any
size costs no more rows than its members. Exact copies enter once, with their number.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import columns_of, components, saved

TILE = 4096
SLACK = 1e-5  # more than single precision loses in a bound
BLOCK = 512
PAIRS_AT_ONCE = 100_000


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    """The vectors of a batch as doubles; shorter ones are filled up with zeros."""
    out = np.zeros((batch.num_rows, dim))
    for i, v in enumerate(batch.column("embedding").to_numpy(zero_copy_only=False)):
        out[i, :len(v)] = v
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def principal_axes(vectors: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Axes (as columns, most variance first) and variances of the unit vectors, over all rows.

    The driver gets one number for each pair of components.
    """
    def moments(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            if batch.num_rows:
                u = _unit(_matrix(batch, dim))
                total += u.T @ u
        i, j = np.triu_indices(dim)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "v"])

    rows = vectors.select("embedding").mapInArrow(moments, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    m = np.zeros((dim, dim))
    for r in rows:
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["v"]
    values, axes = np.linalg.eigh(m)
    return np.ascontiguousarray(axes[:, ::-1]), np.maximum(values[::-1], 0)


def _steps(variances: np.ndarray, threshold: float) -> list[int]:
    """How many leading components are known after each step: the first step takes the share that
    lets an average pair be given up, later ones double it."""
    share = np.cumsum(variances) / max(variances.sum(), 1e-300)
    k = int(np.searchsorted(share, min(1 - threshold + 0.25, 1.0))) + 1
    out = [min(max(k, 4), len(variances))]
    while out[-1] < len(variances):
        out.append(min(2 * out[-1], len(variances)))
    return out


def _linked(ua: np.ndarray, ub: np.ndarray, ra: np.ndarray, rb: np.ndarray, steps: list[int], threshold: float, same: bool):
    """Blocks of linked places (i, j); ``same`` compares a tile with itself, each pair once."""
    def rest(r: np.ndarray, k: int) -> np.ndarray:
        return np.sqrt(np.maximum(1 - np.einsum("ij,ij->i", r[:, :k], r[:, :k]), 0))

    suffix = {k: (rest(ra, k), rest(rb, k)) for k in steps}
    k = steps[0]
    # The bound is one product: the leading components and, as one more, the remaining norm.
    lead_a = np.hstack([ra[:, :k], suffix[k][0][:, None]]).astype(np.float32)
    lead_b = np.hstack([rb[:, :k], suffix[k][1][:, None]]).astype(np.float32)
    for at in range(0, len(ua), BLOCK):
        bound = lead_a[at:at + BLOCK] @ lead_b.T
        open_ = bound >= threshold - SLACK
        if same:
            open_ &= np.arange(len(ub))[None, :] > np.arange(at, at + len(bound))[:, None]
        if open_.mean() > 0.1:  # a dense block: one full product costs less than single pairs
            i, j = np.nonzero(open_ & (ua[at:at + BLOCK] @ ub.T >= threshold))
            yield i + at, j
            continue
        all_i, all_j = np.nonzero(open_)
        for p in range(0, len(all_i), PAIRS_AT_ONCE):
            i, j = all_i[p:p + PAIRS_AT_ONCE] + at, all_j[p:p + PAIRS_AT_ONCE]
            known = np.einsum("ij,ij->i", ra[i, :k], rb[j, :k])
            for before, after in zip(steps, steps[1:]):
                known = known + np.einsum("ij,ij->i", ra[i, before:after], rb[j, before:after])
                keep = known + suffix[after][0][i] * suffix[after][1][j] >= threshold - SLACK
                i, j, known = i[keep], j[keep], known[keep]
            keep = np.einsum("ij,ij->i", ua[i], ub[j]) >= threshold
            yield i[keep], j[keep]


def _join_labels(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the groups that links connect; a label is the least place of its group."""
    while len(i):
        a, b = labels[i], labels[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        least = np.minimum(a, b)
        np.minimum.at(labels, a, least)
        np.minimum.at(labels, b, least)
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels[:] = up


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding",
                    tile: int = TILE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (smallest id reachable by links), kept (is it itself).

    Links are pairs with cosine >= threshold, computed in double precision. Null and zero vectors,
    vectors with null or non-finite components and rows with a null id link with nothing: no links,
    their own id as component, kept. A shorter vector counts as filled up with zeros. Rows that repeat
    an id stay rows, and the links of each of their vectors count for the id; copies count as links. An empty
    table gives an empty result. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = columns_of(vectors, vec_id=id_col, embedding=vector_col)
    good = F.col("vec_id").isNotNull() & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(math.inf)))
    good = F.coalesce(good & F.exists("embedding", lambda v: v != 0), F.lit(False))
    rows = rows.withColumn("good", good)
    heads = saved(rows.where("good").groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")), "vectors")
    n, dim = heads.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    if n:
        links, found = _compare(heads, n, dim, threshold, tile)
    else:
        links = spark.createDataFrame([], "node long, links long")
        found = spark.createDataFrame([], "node long, component_id long")
    facts = heads.join(links, "node", "left").join(found, "node", "left")
    facts = facts.select("embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
                         F.coalesce("component_id", "node").alias("component"))
    out = rows.where("good").join(facts, "embedding").select("vec_id", F.col("links").cast("long").alias("n_links"), F.col("component").alias("component_id"))
    alone = rows.where(~F.col("good")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = out.union(alone)
    return out.select("*", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _compare(heads: DataFrame, n: int, dim: int, threshold: float, tile: int) -> tuple[DataFrame, DataFrame]:
    axes, variances = principal_axes(heads, dim)
    steps = _steps(variances, threshold)
    kind = heads.schema["node"].dataType.simpleString()

    def first_component(batches):
        for batch in batches:
            if batch.num_rows:
                first = _unit(_matrix(batch, dim)) @ axes[:, 0]
                yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("copies"), batch.column("embedding"), pa.array(first)],
                                                 ["node", "copies", "embedding", "first"])

    vector = heads.schema["embedding"].dataType.simpleString()
    placed = saved(heads.mapInArrow(first_component, f"node {kind}, copies long, embedding {vector}, first double"), "placed")
    # One number per tile on the driver: the edges of the tiles along the first component.
    slices = max(1, math.ceil(n / tile))
    edges = sorted(set(placed.approxQuantile("first", [i / slices for i in range(1, slices)], 0.1 / slices))) if slices > 1 else []
    cut = F.lit(0) if not edges else F.aggregate(F.lit(edges), F.lit(0), lambda acc, e: acc + (F.col("first") >= e).cast("int"))
    placed = placed.withColumn("slice", cut)
    # Vectors that share a first component fall into one slice however many they are; it is dealt into tiles by id.
    counts = {r["slice"]: r["count"] for r in placed.groupBy("slice").count().collect()}
    start, deal, at = {}, {}, 0
    for s in sorted(counts):
        deal[s] = max(1, math.ceil(counts[s] / (2 * tile)))
        start[s] = at
        at += deal[s]
    order = max(counts) + 1
    starts, deals = F.lit([start.get(s, 0) for s in range(order)]), F.lit([deal.get(s, 1) for s in range(order)])
    number = F.element_at(starts, F.col("slice") + 1) + F.pmod(F.xxhash64("node"), F.element_at(deals, F.col("slice") + 1).cast("long"))
    placed = placed.withColumn("tile", number.cast("int"))
    reaches = {r["tile"]: (r["lo"], r["hi"]) for r in placed.groupBy("tile").agg(F.min("first").alias("lo"), F.max("first").alias("hi")).collect()}
    tiles = np.array(sorted(reaches))
    lows, highs = np.array([reaches[t][0] for t in tiles]), np.array([reaches[t][1] for t in tiles])
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.zeros((len(pdf), dim))
        for i, v in enumerate(pdf["embedding"]):
            x[i, :len(v)] = v
        return pd.DataFrame({"tile": [key[0]], "nodes": [pdf["node"].to_numpy(np.int64).tobytes()],
                             "copies": [pdf["copies"].to_numpy(np.int64).tobytes()], "body": [x.tobytes() if vector != "array<float>" else x.astype(np.float32).tobytes()]})

    packed = placed.groupBy("tile").applyInPandas(pack, "tile int, nodes binary, copies binary, body binary")

    def meet(batches):
        for batch in batches:
            for row in batch.to_pylist():
                p = int(np.searchsorted(tiles, row["tile"]))
                near = (lows - highs[p] <= reach) & (lows[p] - highs <= reach)
                for q in np.flatnonzero(near):
                    lo, hi = sorted((int(tiles[p]), int(tiles[q])))
                    yield pa.RecordBatch.from_pylist([{"lo": lo, "hi": hi, **row}], pa.schema(
                        [("lo", pa.int32()), ("hi", pa.int32()), ("tile", pa.int32()), ("nodes", pa.binary()), ("copies", pa.binary()), ("body", pa.binary())]))

    met = saved(packed, "tiles").mapInArrow(meet, "lo int, hi int, tile int, nodes binary, copies binary, body binary")
    number_type = np.float32 if vector == "array<float>" else np.float64

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("tile")
        nodes = [np.frombuffer(b, np.int64) for b in pdf["nodes"]]
        copies = [np.frombuffer(b, np.int64) for b in pdf["copies"]]
        units = [_unit(np.frombuffer(b, number_type).reshape(-1, dim).astype(np.float64)) for b in pdf["body"]]
        turned = [u @ axes for u in units]
        same, last = len(nodes) == 1, len(nodes) - 1
        ids = nodes[0] if same else np.concatenate(nodes)
        shift = 0 if same else len(nodes[0])
        links, labels = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for i, j in _linked(units[0], units[last], turned[0], turned[last], steps, threshold, same):
            links += np.bincount(i, copies[last][j], len(ids)).astype(np.int64)
            links += np.bincount(j + shift, copies[0][i], len(ids)).astype(np.int64)
            _join_labels(labels, i, j + shift)
        counted, hung = np.flatnonzero(links), np.flatnonzero(labels != np.arange(len(labels)))
        return pd.DataFrame({"a": np.concatenate([ids[counted], ids[hung]]),
                             "b": pd.array(np.concatenate([np.zeros(len(counted), np.int64), ids[labels[hung]]]), "Int64"),
                             "links": pd.array(np.concatenate([links[counted], np.zeros(len(hung), np.int64)]), "Int64")})

    made = saved(met.groupBy("lo", "hi").applyInPandas(compare, "a long, b long, links long"), "links")
    links = made.where("links > 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    return links, components(made.where("links = 0").select("a", "b"))


#: Links by all pairs, and what each vector can reach.
ORACLE = """
    WITH RECURSIVE links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
        AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.9),
    reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
    found AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM found"""
