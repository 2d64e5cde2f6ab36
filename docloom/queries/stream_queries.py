"""Streams over the given tables, run to the end of the input, returning their sinks."""

from pyspark.sql import functions as F

from docloom.operators import chunking, collection
from docloom.plans import retrieval
from docloom.queries import frames
from docloom.queries import sqltext as q
from docloom.queries.registry import query, table
from docloom.session import scratch_path
from docloom.streaming import jobs, memory


def stream(spark, sf, name):
    """One table as a stream, be it a file or a folder of files (as a pattern the path may name either)."""
    schema = table(spark, sf, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{{{name}}}.parquet")


def _remembered(spark, sf):
    out = scratch_path(spark, "threads")
    jobs.start_thread_memory(stream(spark, sf, "conversations"), out, scratch_path(spark, "cp")).awaitTermination()
    return jobs.remembered(spark, out)


@query("stream_thread_memory", """
    SELECT conv_id, count(*) AS n_messages, max(turn) AS last_turn, arg_max(role, turn) AS last_role,
        arg_max(text, turn) AS last_text FROM conversations GROUP BY conv_id""")
def stream_thread_memory(spark, sf):
    return memory.summary(_remembered(spark, sf))


@query("stream_thread_messages", """
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place, turn, role, text FROM conversations""")
def stream_thread_messages(spark, sf):
    return _remembered(spark, sf)


@query("stream_queries", "WITH" + q.ENSEMBLE + """,
    counted AS (SELECT query_id, count(*) AS retrieved_raw, sum(repeat::INT)::BIGINT AS dedupe_removed,
        sum((NOT repeat)::INT)::BIGINT AS final_context FROM ehits GROUP BY query_id)
    SELECT query_id, question, string_agg(chunk_id, ',' ORDER BY final_rank) AS chunks, retrieved_raw, dedupe_removed, final_context,
        count(*) AS n_cited FROM reranked JOIN counted USING (query_id) WHERE final_rank <= 7 GROUP BY ALL""")
def stream_queries(spark, sf):
    out = scratch_path(spark, "answers")
    asked = stream(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))
    # The collection is embedded once, before the stream starts; a batch embeds its questions only.
    held = frames.stored_collection(spark, sf)
    jobs.answer_stream(asked, lambda batch: retrieval.answer_ensemble(batch, held), out, scratch_path(spark, "cp")).awaitTermination()
    answers = spark.read.parquet(f"{out}/delta").where(F.col("prediction").isNotNull() & F.contains("prompt", "question"))
    return answers.select("query_id", "question", F.array_join("final_chunks", ",").alias("chunks"), "retrieved_raw", "dedupe_removed",
                          "final_context", F.regexp_count("context", F.lit(r"(?m)^\[\d+\] chunk_id=")).cast("long").alias("n_cited"))


@query("stream_upsert", "WITH" + q.windows(500, 50) + f"""
    SELECT {q.sid('doc_id', 'source', 'chunk_index', 'content')} AS chunk_uid, doc_id, chunk_index, md5(content) AS content_md5 FROM chunks""", ints="chunk_index")
def stream_upsert(spark, sf):
    out = scratch_path(spark, "ingest")
    docs = stream(spark, sf, "documents").select("doc_id", "source", "text")
    chunks = chunking.with_chunk_uid(chunking.chunk_fixed(docs), index="chunk_index").select(
        "chunk_uid", "doc_id", "chunk_index", F.md5("content").alias("content_md5"))
    # The same input twice: the second ingest must add nothing.
    for run in range(2):
        jobs.ingest_stream(chunks, out, scratch_path(spark, "cp"), run).awaitTermination()
    return collection.read_collection(spark, out, "chunk_uid", "chunk_index")
