"""Keyed collections: rows with stable ids, inserted once and replaced on re-ingest."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def latest(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row per key. Combines on the map side, so a key repeated often stays cheap."""
    others = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("_row"))
    return best.select(key, "_row.*").select(*df.columns)


def upsert(existing: DataFrame, incoming: DataFrame, key: str, order: str) -> DataFrame:
    """Incoming rows replace existing ones with the same key; the last write in a batch wins."""
    fresh = latest(incoming, key, order).select(*existing.columns)
    return existing.join(fresh.select(key), key, "left_anti").select(*existing.columns).unionByName(fresh)


def write_base(rows: DataFrame, path: str, key: str, order: str, *partition_by: str) -> None:
    """First load of a collection. Of rows with one key the last by ``order`` is kept, as in later batches."""
    latest(rows, key, order).write.mode("errorifexists").partitionBy(*partition_by).parquet(f"{path}/base")


def write_delta(batch: DataFrame, path: str, batch_no: int, run: int = 0) -> None:
    """Store one later batch under its run and number; writing it again changes nothing."""
    batch.write.mode("overwrite").parquet(f"{path}/delta/run_no={run}/batch_no={batch_no}")


def read_collection(spark: SparkSession, path: str, key: str, order: str) -> DataFrame:
    """The current rows: the base, with the rows of later batches in place of equal keys.

    Within the batches the last row wins, by run, batch and then ``order``. Only
    the batches are grouped; the base is read as it lies, less the keys replaced.
    """
    base, deltas = _stored(spark, f"{path}/base"), _stored(spark, f"{path}/delta")
    if deltas is None:
        if base is None:
            raise ValueError(f"no collection at {path}")
        return base
    stamped = deltas.withColumn("_at", F.struct("run_no", "batch_no", order))
    fresh = latest(stamped, key, "_at").drop("_at", "run_no", "batch_no")
    if base is None:
        return fresh
    return base.join(fresh.select(key), key, "left_anti").select(*fresh.columns).unionByName(fresh)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
