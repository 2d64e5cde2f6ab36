"""The flows: question to answer, and the ensemble over several collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import fixed_values as V
from docloom.operators import chunking, context, embed, ensemble, measure, search
from docloom.session import scratch_path

META = ["chunk_uid", "vector_id", "id", "doc_id", "table_id", "figure_id",
        "source_docx", "source_csv", "source_image", "source_file"]


def with_metadata(df: DataFrame) -> DataFrame:
    """Add the metadata columns a modality does not have, as NULL strings."""
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in META if c not in df.columns])


def stored(chunks: DataFrame) -> DataFrame:
    """Chunks with their vectors as a table: embedded and written once, so search and content need no second pass
    over the documents. A frame that has vectors is taken as it is."""
    if "embedding" in chunks.columns:
        return chunks
    path = scratch_path(chunks.sparkSession, "chunks")
    rows = embed.embed(chunks, "content")
    rows.write.parquet(path)
    return chunks.sparkSession.read.schema(rows.schema).parquet(path)


def retrieve(questions: DataFrame, chunks: DataFrame, k: int, chunk_id: str = "chunk_id",
             group: str | None = None) -> DataFrame:
    """Ranked hits with their content; ``questions(query_id, question)``, ``chunks(chunk_id, content, ...)``."""
    asked = embed.embed(questions, "question")
    held = stored(chunks)
    few = search.few_queries(asked, "query_id", "embedding")
    hits = search.knn(asked, held, k, vector_id=chunk_id, group=group, few=few)
    payload = held.drop("embedding", *([group] if group else []))
    return search.with_payload(hits, payload, chunk_id, None if group else search.hits_at_most(few, k))


def answer_questions(questions: DataFrame, chunks: DataFrame, k: int = V.TOP_K,
                     style: str = "source", layout: str = "question_first", completer=None) -> DataFrame:
    """load -> split -> embed -> search -> context -> prompt -> answer, all questions as one job."""
    hits = retrieve(questions, chunks, k)
    contexts = context.build_context(hits, style)
    asked = questions.join(contexts, "query_id")
    prompted = asked.withColumn("prompt", context.rag_prompt(layout, F.col("question"), F.col("context")))
    return context.answer(prompted, completer=completer)


def ensemble_hits(questions: DataFrame, collection: DataFrame, per_modality: int = V.TOP_K_PER_MODALITY,
                  final: int = V.FINAL_CONTEXT_K) -> DataFrame:
    """Nearest rows per modality, merged by distance and cut; then content and metadata attached.

    ``collection(chunk_id, modality, content, metadata...)`` holds all modalities:
    one scan serves every collection. Deduplication and reranking follow the cut.
    """
    asked = embed.embed(questions, "question")
    held = stored(collection)
    few = search.few_queries(asked, "query_id", "embedding")
    hits = search.knn(asked, held, per_modality, vector_id="chunk_id", group="modality", few=few)
    merged = ensemble.ensemble(hits, final).withColumnRenamed("score", "retrieval_score").drop("rank")
    rows = search.with_payload(merged, held.drop("embedding", "modality"), "chunk_id", search.hits_at_most(few, final))
    marked = rows.withColumn("fingerprint", ensemble.fingerprint())
    return ensemble.dedupe_small_lists(marked, "query_id", "fingerprint", "ensemble_rank")


def ensemble_context(questions: DataFrame, collection: DataFrame, scorer=ensemble.lexical_overlap,
                     use_reranker: bool = True) -> DataFrame:
    """Ensemble hits -> dedupe -> rerank -> cited context and prompt per question."""
    kept = ensemble_hits(questions, collection).where(~F.col("repeat"))
    if use_reranker:
        final = ensemble.rerank(ensemble.pairs(questions, kept), V.FINAL_CONTEXT_K, scorer=scorer)
    else:
        final = ensemble.pairs(questions, kept).withColumn("rerank_score", F.lit(None).cast("double")).withColumn(
            "final_rank", F.col("ensemble_rank"))
    contexts = context.build_context(final, "index", ["query_id", "question"], "final_rank")
    return contexts.withColumn("prompt", context.rag_prompt("cited", F.col("question"), F.col("context")))


def answer_ensemble(questions: DataFrame, collection: DataFrame, scorer=ensemble.lexical_overlap) -> DataFrame:
    """Question to answer over all modalities, one row each: retrieved, deduplicated, reranked, answered and counted.

    The short hit list of a question is used twice, for its counts and its contexts, so it is stored once.
    """
    path = scratch_path(collection.sparkSession, "hits")
    ensemble_hits(questions, collection).write.parquet(path)
    hits = collection.sparkSession.read.parquet(path)
    kept = ensemble.pairs(questions, hits.where(~F.col("repeat")))
    final = ensemble.rerank(kept, V.FINAL_CONTEXT_K, scorer=scorer)
    contexts = context.build_context(final, "index", ["query_id", "question"], "final_rank")
    ranked = final.groupBy("query_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("final_rank", "chunk_id"))), lambda h: h["chunk_id"]).alias("final_chunks"))
    prompted = contexts.withColumn("prompt", context.rag_prompt("cited", F.col("question"), F.col("context")))
    return context.answer(prompted).join(measure.trace_counts(hits), "query_id").join(ranked, "query_id")


def text_collection(documents: DataFrame, size: int = V.LONG_CHUNK_SIZE, overlap: int = V.LONG_CHUNK_OVERLAP,
                    recursive: bool = True) -> DataFrame:
    """Text chunks with per-document ids that stay put when other documents change."""
    cut = chunking.chunk_text if recursive else chunking.chunk_fixed
    chunks = chunking.with_chunk_uid(cut(documents, size, overlap), index="chunk_index")
    return with_metadata(chunks.select(
        F.col("chunk_uid").alias("chunk_id"), F.lit("text").alias("modality"), "content", "chunk_uid",
        F.col("doc_id").cast("string").alias("doc_id"), F.col("source").alias("source_docx")))


def table_collection(df: DataFrame, doc: str, table: str, order_by: list[str], bucket: list[Column],
                     cols: list[str]) -> DataFrame:
    docs = chunking.table_documents(df, doc, table, order_by, bucket, cols)
    return with_metadata(docs.select(
        F.col("vector_id").alias("chunk_id"), "modality", "content", "vector_id",
        F.col(doc).alias("doc_id"), F.col(table).alias("table_id")))


def image_collection(images: DataFrame, prompt_version: str) -> DataFrame:
    """``images(doc_id, figure_id, source_image, content)``: description records as text."""
    from docloom.functions.text import stable_id

    vid = stable_id(F.col("doc_id"), F.col("figure_id"), F.lit(prompt_version))
    return with_metadata(images.select(
        vid.alias("chunk_id"), F.lit("image_vlm").alias("modality"), "content", vid.alias("vector_id"),
        F.col("doc_id").cast("string").alias("doc_id"), "figure_id", "source_image"))
