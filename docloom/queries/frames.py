"""Frames several registered queries start from, all derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import chunking, ensemble, search
from docloom.operators.numbering import integer_bucket
from docloom.plans import ingest, retrieval
from docloom.queries.registry import table, wide
from docloom.session import scratch_path

VECTOR_DIM = 64


def centroids(spark: SparkSession, sf: str) -> DataFrame:
    """One query vector per label: the mean of its vectors, combined on the map side."""
    means = ", ".join(f"avg(double(embedding[{i}]))" for i in range(VECTOR_DIM))
    return table(spark, sf, "embeddings").groupBy(F.col("label").alias("query_id")).agg(
        F.expr(f"array({means})").alias("embedding"))


def hits(spark: SparkSession, sf: str, k: int = 10) -> DataFrame:
    """Ranked neighbours of the label centroids with document content and source."""
    queries = centroids(spark, sf)
    few = search.few_queries(queries, "query_id", "embedding")
    found = search.knn(queries, table(spark, sf, "embeddings"), k, few=few)
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("vec_id"), F.col("text").alias("content"), "source", "lang")
    return search.with_payload(found, docs, "vec_id", search.hits_at_most(few, k))


def metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with hit metadata that is filled, empty or missing by modality."""
    n, lang, doc = F.col("n_chars"), F.col("lang"), F.col("doc_id").cast("string")
    return wide(spark, sf, "documents", "doc_id", "text", "lang", "source", "n_chars").select(
        F.col("doc_id").alias("row_id"), F.col("text").alias("content"),
        F.when((lang == "en") & (n % 2 == 0), F.concat(F.lit("c"), doc)).otherwise("").alias("chunk_uid"),
        F.when(lang == "fr", F.concat(F.lit("v"), doc)).alias("vector_id"),
        F.when((lang == "de") & (n % 3 == 0), F.concat(F.lit("i"), doc)).alias("id"),
        F.when(n % 5 != 0, doc).otherwise("").alias("doc_id"),
        F.when(lang == "es", F.concat(F.lit("table_"), n % 7)).alias("table_id"),
        F.when(lang == "de", F.lit("")).alias("figure_id"),
        F.when(lang == "en", F.concat("source", F.lit(".docx"))).alias("source_docx"),
        F.when(lang == "es", F.concat("source", F.lit(".csv"))).otherwise("").alias("source_csv"),
        F.when(n % 2 == 1, F.concat("source", F.lit(".png"))).alias("source_image"),
        F.lit(None).cast("string").alias("source_file"),
    )


def questions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))


def fixed_chunks(spark: SparkSession, sf: str) -> DataFrame:
    docs = wide(spark, sf, "documents", "doc_id", "source", "text")
    chunks = chunking.chunk_fixed(docs)
    return chunks.withColumn("chunk_id", F.concat(F.col("doc_id"), F.lit(":"), F.col("chunk_index")))


PART_COLS = ["p_partkey", "p_name", "p_brand", "p_size"]


def part_tables(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.lit("part").alias("doc_id"), F.col("p_type").alias("table_id"), *PART_COLS)


def figures(spark: SparkSession, sf: str) -> DataFrame:
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return wide(spark, sf, "pages", "page_id", "url", "html").select(
        F.col("page_id").alias("doc_id"), F.concat(F.lit("figure_"), "page_id").alias("figure_id"),
        F.col("url").alias("source_image"),
        F.to_json(F.struct(F.lit("screenshot").alias("type"), title.alias("summary"))).alias("content"))


def collection(spark: SparkSession, sf: str) -> DataFrame:
    """Text, table and image chunks of the given tables as one frame."""
    return ensemble.union_hits(*modalities(spark, sf))


def modalities(spark: SparkSession, sf: str) -> list[DataFrame]:
    docs = wide(spark, sf, "documents", "doc_id", "source", "text")
    return [
        retrieval.text_collection(docs, 500, 50, recursive=False),
        retrieval.table_collection(part_tables(spark, sf), "doc_id", "table_id", ["p_partkey"],
                                   integer_bucket("p_partkey"), PART_COLS),
        retrieval.image_collection(figures(spark, sf), "v1"),
    ]


def stored_collection(spark: SparkSession, sf: str) -> DataFrame:
    """The same chunks after an ingest: embedded, written and read back."""
    path = scratch_path(spark, "collection")
    ingest.store(path, *modalities(spark, sf))
    return ingest.open_collection(spark, path)


def ensemble_hits(spark: SparkSession, sf: str) -> DataFrame:
    return retrieval.ensemble_hits(questions(spark, sf), stored_collection(spark, sf))
