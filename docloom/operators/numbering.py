"""Row numbers, ordered batches and keep-first selection without one-task windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.session import written


def row_positions(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[Column | str],
    bucket: Sequence[Column],
    out: str = "position",
    total: str | None = None,
) -> DataFrame:
    """0-based position of each row within its group, safe for a group of any size.

    ``bucket`` must not be NULL and must never decrease along ``order_by``. Rows
    are ranked inside ``(group, bucket)``, and each bucket starts where the counts
    of the buckets before it end. So the largest sort is one bucket, not one group,
    and the running sum covers one short row per bucket. The join reuses the
    window's partitioning: the rows are shuffled once. ``total`` names an optional
    column with the size of the group.
    """
    # Group keys without NULLs, so that a plain equality keeps every row.
    parts = [c for i, p in enumerate(partition_by) for c in (
        F.isnull(p).alias(f"_m{i}"), F.coalesce(F.col(p).cast("string"), F.lit("")).alias(f"_g{i}"))]
    groups = [f"_{kind}{i}" for i in range(len(partition_by)) for kind in ("m", "g")]
    keys = [f"_b{i}" for i in range(len(bucket))]
    # A declared default keeps the join from adding a NULL filter to one side only,
    # which would stop Spark from reusing an exchange the two sides share.
    kinds = [f.dataType for f in df.select(*bucket).schema.fields]
    solid = [F.coalesce(b, F.lit("") if isinstance(t, T.StringType) else F.lit(0).cast(t)) for b, t in zip(bucket, kinds)]
    tagged = df.select("*", *parts, *[b.alias(k) for b, k in zip(solid, keys)])
    sizes = tagged.groupBy(*groups, *keys).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    before = whole.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *groups, *keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        *([F.sum("_n").over(whole).alias(total)] if total else []))
    inside = Window.partitionBy(*groups, *keys).orderBy(*order_by)
    ranked = tagged.withColumn("_rank", F.row_number().over(inside) - 1)
    return ranked.join(starts, [*groups, *keys]).select(
        *df.columns, (F.col("_start") + F.col("_rank")).cast("long").alias(out), *([total] if total else []))


def ranged_positions(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[Column | str],
    out: str = "position",
    total: str | None = None,
) -> DataFrame:
    """0-based position of each row within its group, whatever the keys look like.

    The rows are cut into ranges of (group, order) at sampled quantiles, so neither one group nor one
    key value's neighbourhood decides how many rows share a task; only rows that agree in the whole key stay together.
    Each range is sorted once and written with its running number; what is numbered is read twice, once for
    the sample. What the ranges before hold of a group is a running sum over one short row per (group, range): at most as
    many as there are ranges.
    """
    keys = [*partition_by, *order_by]
    cut = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = written(cut.withColumn("_at", F.monotonically_increasing_id()), "positions").withColumn("_range", F.expr("_at >> 33"))
    sizes = placed.groupBy(*partition_by, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*partition_by) if partition_by else Window.partitionBy(F.lit(0))
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(partition_by)], F.col("_range").alias("_r"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        *([F.sum("_n").over(whole).alias(total)] if total else []))
    same = F.col("_range") == F.col("_r")
    for i, c in enumerate(partition_by):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return placed.join(starts, same).select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_at") + F.col("_shift")).alias(out), *([total] if total else []))


def integer_bucket(key: str | Column, width: int = 65_536) -> list[Column]:
    """Bucket for a unique, roughly dense integer key: at most ``width`` rows share one."""
    c = F.col(key) if isinstance(key, str) else key
    return [F.floor(c / F.lit(width))]


def even_bucket(df: DataFrame, key: str, rows: int = 65_536) -> list[Column]:
    """Bucket for a sparse numeric key (hashes, clock ticks): about ``rows`` rows share one.

    Reads the range and the count of the key first, so that the number of buckets
    follows the number of rows and not the size of the ids.
    """
    low, high, n = df.agg(F.min(key), F.max(key), F.count(key)).first()
    if not n:
        return [F.lit(0)]
    width = max(1.0, (float(high) - float(low)) * rows / n)
    return [F.floor((F.col(key).cast("double") - F.lit(float(low))) / F.lit(width))]


def number_within(
    df: DataFrame, partition_by: Sequence[str], key: str, out: str = "number",
    bucket: Sequence[Column] | None = None,
) -> DataFrame:
    """1-based counter per group along a unique integer key, plus its 3-digit label."""
    numbered = row_positions(df, partition_by, [key], bucket or integer_bucket(key), "_p")
    return numbered.withColumn(out, F.col("_p") + 1).withColumn(
        f"{out}_label", F.format_string("%03d", F.col(out))
    ).drop("_p")


def with_global_index(chunks: DataFrame, doc: str = "doc_id", local: str = "chunk_index") -> DataFrame:
    """1-based index over all chunks in document order, however the ids lie and however long a document is."""
    placed = ranged_positions(chunks, [], [doc, local], "_p")
    return placed.withColumn("chunk_index_global", F.col("_p") + 1).drop("_p")


def head_percent(df: DataFrame, percent: float, key: str) -> DataFrame:
    """The first ``percent`` of the rows along a unique key, to the nearest row."""
    placed = ranged_positions(df, [], [key], "_p", total="_n")
    return placed.where(F.col("_p") < F.round(F.col("_n") * percent / 100)).drop("_p", "_n")


def batches(df: DataFrame, size: int, key: str, seed: str) -> DataFrame:
    """Shuffle by a seeded hash of the key and cut into batches; the last may be short."""
    mixed = df.withColumn("_h", F.md5(F.concat(F.col(key).cast("string"), F.lit(":" + seed))))
    placed = ranged_positions(mixed, [], ["_h", key], "_p")
    return placed.select(
        *df.columns,
        F.floor(F.col("_p") / size).cast("long").alias("batch"),
        (F.col("_p") % size).cast("long").alias("slot"),
    )


def limit_sorted(df: DataFrame, order_by: Sequence[Column | str], n: int | None) -> DataFrame:
    """Sorted rows with an optional cap (planned as one top-n, not a full sort)."""
    ordered = df.orderBy(*order_by)
    return ordered if n is None else ordered.limit(n)


def distinct_sorted(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct().orderBy(*cols)


def top_k(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column | str], k: int,
          out: str = "rank") -> DataFrame:
    """Best k rows per group with a 1-based rank.

    The bound on row_number lets Spark cut every map task to k rows per group
    before the exchange, so a hot group never arrives whole.
    """
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= k)


def keep_first(df: DataFrame, group: Sequence[str], order: str) -> DataFrame:
    """The first row of each group along a unique order column; one pass, one shuffle."""
    return top_k(df, group, [order], 1, "_first").drop("_first")


def removed_rows(df: DataFrame, group: Sequence[str], order: str) -> DataFrame:
    """The rows :func:`keep_first` drops.

    min() combines on the map side, and the join runs on the unique order column,
    so a group of copies of any size never meets in one task.
    """
    firsts = df.groupBy(*group).agg(F.min(order).alias(order)).select(order)
    return df.join(firsts, order, "left_anti")
