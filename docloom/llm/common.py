"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.session import scratch_path


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a frame under ``spark.checkpoint.dir`` and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a frame that ``saved`` returned, once nothing reads it any more."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def columns_of(df: DataFrame, **wanted: str) -> DataFrame:
    """The named inputs under fixed names; whatever else the frame holds is left behind, so no name can clash."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in wanted.items()])


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fits(df: DataFrame, rows: int) -> bool:
    """Whether a frame has at most so many rows; reads no further than one row beyond."""
    return len(df.limit(rows + 1).select(F.lit(1)).collect()) <= rows


def joined_small(left: DataFrame, right: DataFrame, on, how: str = "inner", rows: int = 20_000) -> DataFrame:
    """Join with a side that is broadcast only if a count proves it small; beyond that an ordinary join."""
    return left.join(F.broadcast(right) if fits(right, rows) else right, on, how)


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of an array of (start, place, end, kind) structs in its order, comma-joined."""
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _distinct_edges(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("a") != F.col("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node moves to the smallest node next to it."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.where(F.col("b") > F.col("a")).join(least, "a")
    return _distinct_edges(moved.select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """The neighbours below a node, and the node itself, move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _distinct_edges(moved.union(least.select("a", F.col("m").alias("b"))))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Smallest node that each node of an undirected edge list (``a``, ``b``) can reach: (node, component_id).

    Alternating large and small stars. Each round is written to the shared folder;
    only one fingerprint of the edge list returns to the driver, to see whether the
    round changed anything. Nodes without an edge do not appear. A self link adds nothing.
    """
    spark = edges.sparkSession
    now, before = saved(_distinct_edges(edges.select("a", "b").na.drop()), "edges"), None
    for _ in range(rounds):
        now = saved(_small_star(_large_star(now)), "edges")
        seen = now.agg(F.count(F.lit(1)), F.expr("sum(cast(xxhash64(a, b) as decimal(20, 0)))")).first()
        if seen == before or not seen[0]:
            break
        before = seen
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component_id")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component_id")).union(roots)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often and wherever ``use`` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)
