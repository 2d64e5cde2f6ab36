"""Sharding by proportional stratified interleaving.

Rows are ranked in a seeded random order within their source, placed by fractional
rank ``(rank + 0.5) / rows of the source``, and the one order over all sources is cut
into shards. Each stretch of that order holds every source in its share of the whole.

No source is ever sorted in one task: the seeded hash is uniform, so a source is ranked
inside slices of the hash range and the counts of the earlier slices are added. The order
over all sources is numbered the same way, in slices of the fractional rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import columns_of, saved

#: Rows that a slice should hold, and the most slices; beyond that slices grow.
SLICE_ROWS, MOST_SLICES = 512, 65_536
_RANGE = 1 << 63


def _numbered(rows: DataFrame, group: list[str], slice_: str, order: list, into: str) -> DataFrame:
    """0-based number of each row in its group, where ``slice_`` rises with ``order``."""
    counts = rows.groupBy(*group, slice_).agg(F.count(F.lit(1)).alias("in_slice"))
    earlier = Window.partitionBy(*group or [F.lit(0)]).orderBy(slice_).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("in_slice").over(earlier), F.lit(0))).drop("in_slice")
    inside = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*group, slice_).orderBy(*order)))
    return inside.join(counts, [*group, slice_]).withColumn(into, F.col("before") + F.col("_n") - 1).drop("before", "_n")


def interleave(docs: DataFrame, shards: int = 24, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source") -> DataFrame:
    """Place every row into one of ``shards`` shards whose source mixture matches the whole.

    Returns doc_id, size (UTF-8 bytes + 8), text_crc32, law (``rows``: shard counts differ by at
    most one), shard, slot (gapless from 0 inside a shard), grown_shard (null under this law),
    source and fraction (the fractional rank).

    A null text counts as empty (size 8, checksum 0). A null source is a source of its own, apart
    from the empty one. Null and repeated ids are kept; rows that agree in id, size and checksum are
    interchangeable. With fewer rows than shards the last shards stay empty; an empty table gives an
    empty result. Other columns are ignored.
    """
    rows = columns_of(docs, doc_id=id_col, text=text_col, source=source_col)
    text = F.coalesce("text", F.lit(""))
    rows = saved(rows.select(
        "doc_id", "source",
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("stratum"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.expr(f"shiftrightunsigned(xxhash64({seed}L, doc_id), 1)").alias("draw"),
    ), "shard-rows")
    total = rows.count()
    slices = max(1, min(-(-total // SLICE_ROWS), MOST_SLICES))
    tie = ["doc_id", "text_crc32", "size"]
    rows = rows.withColumn("draw_slice", F.expr(f"draw div {min(-(-_RANGE // slices), _RANGE - 1)}L"))
    ranked = _numbered(rows, ["stratum"], "draw_slice", ["draw", *tie], "rank")
    sizes = rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("of"))
    ranked = ranked.join(sizes, "stratum").withColumn("fraction", F.expr("(2 * rank + 1) / (2.0D * of)"))
    ranked = ranked.withColumn("part", F.floor(F.col("fraction") * slices))
    placed = _numbered(ranked, [], "part", ["fraction", "stratum", "draw", *tie], "position")
    shard = F.expr(f"position * {shards} div {max(total, 1)}L")
    return placed.withColumn("shard", shard.cast("int")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        F.expr(f"position - cast(ceil(cast(shard as decimal(20,0)) * {max(total, 1)}L / {shards}) as long)").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "source", "fraction")
