"""Ingest: chunks of all modalities, embedded once and kept as one collection table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docloom.operators import collection, embed, ensemble

KEY = "chunk_id"


def store(path: str, *modalities: DataFrame, embedder=None) -> None:
    """First ingest: embed every chunk and write the collection, one folder per modality."""
    collection.write_base(_embedded(modalities, embedder), path, KEY, "modality", "modality")


def update(path: str, *modalities: DataFrame, embedder=None, run: int, batch_no: int = 0) -> None:
    """A later ingest. Ids are stable, so rows ingested again replace, never add."""
    collection.write_delta(_embedded(modalities, embedder), path, batch_no, run)


def open_collection(spark: SparkSession, path: str) -> DataFrame:
    """The current rows with their vectors."""
    return collection.read_collection(spark, path, KEY, "modality")


def _embedded(modalities, embedder) -> DataFrame:
    return embed.embed(ensemble.union_hits(*modalities), "content", embedder=embedder)
