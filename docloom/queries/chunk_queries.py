"""Chunking and identity."""

from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.operators import chunking, numbering
from docloom.operators.numbering import integer_bucket
from docloom.queries import frames
from docloom.queries import sqltext as q
from docloom.queries.registry import query, table, wide
from docloom.session import scratch_path

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
ORDER_CHUNKS = q.row_chunks("oc", "orders", "o_orderpriority", "o_orderkey", ", ".join(ORDER_COLS))


def _order_rows(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderpriority", *ORDER_COLS)
    return chunking.chunk_rows(orders, ["o_orderpriority"], ["o_orderkey"], integer_bucket("o_orderkey"))


@query("chunk_recursive", "WITH RECURSIVE" + q.recursive_chunks(500, 50) + """
    SELECT doc_id, source, chunk_index, start, content FROM rchunks JOIN documents USING (doc_id)""", ints="chunk_index start")
def chunk_recursive(spark, sf):
    return chunking.chunk_text(wide(spark, sf, "documents", "doc_id", "source", "text"))


@query("table_valued_chunker", "WITH RECURSIVE" + q.recursive_chunks(1200, 150) + """
    SELECT doc_id, chunk_index, start, content FROM rchunks""", ints="chunk_index start")
def table_valued_chunker(spark, sf):
    chunking.register_chunker(spark)
    wide(spark, sf, "documents", "doc_id", "text").createOrReplaceTempView("documents_to_chunk")
    return spark.sql("SELECT doc_id, chunk_index, start, content FROM chunk(TABLE(documents_to_chunk), 1200, 150)")


@query("chunk_stats", "WITH" + q.windows(500, 50) + """
    SELECT source, count(*) AS n_chunks, min(length(content)) AS min_chars, round(avg(length(content)), 6) AS avg_chars,
        max(length(content)) AS max_chars FROM chunks GROUP BY source""", ints="min_chars max_chars")
def chunk_stats(spark, sf):
    stats = chunking.chunk_stats(frames.fixed_chunks(spark, sf))
    return stats.withColumn("avg_chars", F.round("avg_chars", 6))


@query("chunk_fixed", "WITH" + q.windows(500, 50) + "SELECT doc_id, source, chunk_index, start, content FROM chunks", ints="chunk_index start")
def chunk_fixed(spark, sf):
    return frames.fixed_chunks(spark, sf).drop("chunk_id")


@query("table_row_chunks", "WITH" + ORDER_CHUNKS + """
    SELECT part AS o_orderpriority, o_orderkey, r AS row_number, c + 1 AS chunk_index_in_table, r0 AS row_start,
        r1 AS row_end_exclusive, n AS total_rows FROM oc""", ints="chunk_index_in_table row_start row_end_exclusive")
def table_row_chunks(spark, sf):
    return _order_rows(spark, sf).select("o_orderpriority", "o_orderkey", "row_number", "chunk_index_in_table",
                                         "row_start", "row_end_exclusive", "total_rows")


@query("serialize_rows_markdown", "WITH" + ORDER_CHUNKS + """
    SELECT part AS o_orderpriority, c + 1 AS chunk_index_in_table,
        '| o_orderkey | o_custkey | o_orderstatus | o_totalprice |' || chr(10) || '| --- | --- | --- | --- |' || chr(10)
        || string_agg('| ' || o_orderkey || ' | ' || o_custkey || ' | ' || o_orderstatus || ' | ' || o_totalprice || ' |',
                      chr(10) ORDER BY r) AS body FROM oc GROUP BY part, c""", ints="chunk_index_in_table")
def serialize_rows_markdown(spark, sf):
    return chunking.rows_to_text(_order_rows(spark, sf), ["o_orderpriority", "chunk_index_in_table"], ORDER_COLS)


@query("serialize_rows_csv", "WITH" + ORDER_CHUNKS + """
    SELECT part AS o_orderpriority, c + 1 AS chunk_index_in_table,
        'o_orderkey,o_custkey,o_orderstatus,o_totalprice' || chr(10)
        || string_agg(o_orderkey || ',' || o_custkey || ',' || o_orderstatus || ',' || o_totalprice, chr(10) ORDER BY r)
        AS body FROM oc GROUP BY part, c""", ints="chunk_index_in_table")
def serialize_rows_csv(spark, sf):
    return chunking.rows_to_text(_order_rows(spark, sf), ["o_orderpriority", "chunk_index_in_table"], ORDER_COLS, "csv")


@query("table_chunk_header", "WITH" + q.TABLE_CHUNKS + f"""
    SELECT table_id, c + 1 AS chunk_index_in_table, r0 AS row_start, r1 AS row_end_exclusive, n AS total_rows,
        {q.sid("'part'", 'table_id', 'r0', 'r1', "'markdown'")} AS vector_id, content FROM tdocs""", ints="chunk_index_in_table row_start row_end_exclusive")
def table_chunk_header(spark, sf):
    docs = chunking.table_documents(frames.part_tables(spark, sf), "doc_id", "table_id", ["p_partkey"],
                                    integer_bucket("p_partkey"), frames.PART_COLS)
    return docs.select("table_id", "chunk_index_in_table", "row_start", "row_end_exclusive", "total_rows",
                       "vector_id", "content")


@query("normalize_column_names", "SELECT n_nationkey::BIGINT AS n_nationkey, n_name, n_regionkey::BIGINT AS n_regionkey FROM nation")
def normalize_column_names(spark, sf):
    out = scratch_path(spark, "headers")
    table(spark, sf, "nation").toDF(" n_nationkey", "n_name ", "  n_regionkey ").write.csv(out, header=True)
    raw = spark.read.csv(out, header=True)
    return chunking.strip_columns(raw).select(
        F.col("n_nationkey").cast("long"), "n_name", F.col("n_regionkey").cast("long"))


@query("stable_chunk_id", "WITH" + q.windows(500, 50) + f""",
    g AS (SELECT *, row_number() OVER (ORDER BY doc_id, chunk_index) AS chunk_index_global FROM chunks)
    SELECT doc_id, chunk_index, {q.sid('doc_id', 'source', 'chunk_index_global', 'content')} AS chunk_uid FROM g""", ints="chunk_index")
def stable_chunk_id(spark, sf):
    chunks = numbering.with_global_index(frames.fixed_chunks(spark, sf).drop("chunk_id"))
    return chunking.with_chunk_uid(chunks).select("doc_id", "chunk_index", "chunk_uid")


@query("stable_part_id", f"""
    SELECT page_id, {q.sid('page_id', "'figure_' || page_id", "'v1'")} AS vector_id FROM pages""")
def stable_part_id(spark, sf):
    fig = F.concat(F.lit("figure_"), "page_id")
    return table(spark, sf, "pages").select("page_id", tx.stable_id(F.col("page_id"), fig, F.lit("v1")).alias("vector_id"))


@query("safe_name", r"""
    WITH s AS (SELECT page_id, coalesce(nullif(regexp_replace(regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g'),
        '^_+|_+$', '', 'g'), ''), 'untitled') AS name FROM pages)
    SELECT page_id, name, count(*) OVER (PARTITION BY name) AS n_sharing FROM s""")
def safe_name(spark, sf):
    named = table(spark, sf, "pages").select("page_id", tx.safe_name(F.col("url")).alias("name"))
    shared = named.groupBy("name").agg(F.count(F.lit(1)).alias("n_sharing"))
    return named.join(shared, "name").select("page_id", "name", "n_sharing")


@query("element_numbering", """
    SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS number,
        printf('table_%03d', row_number() OVER (PARTITION BY source ORDER BY doc_id)) AS label FROM documents""")
def element_numbering(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return numbering.number_within(docs, ["source"], "doc_id").select(
        "doc_id", "source", "number", F.concat(F.lit("table_"), "number_label").alias("label"))
