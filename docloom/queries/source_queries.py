"""Scans: documents, rows, pages, layouts, chat rows, question sets, nested columns."""

from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.operators import dialogue, numbering
from docloom.operators.numbering import integer_bucket
from docloom.queries import sqltext as q
from docloom.queries.registry import query, table, wide
from docloom.session import scratch_path
from docloom.sinks import writers
from docloom.sources import documents, records


@query("scan_documents", """
    SELECT doc_id, 'documents.parquet' AS source, length(text) AS n_chars, md5(text) AS content_md5 FROM documents""")
def scan_documents(spark, sf):
    docs = documents.read_documents(spark, f"{sf}/documents.parquet", [".parquet"])
    return docs.select("doc_id", "source", F.length("content").cast("long").alias("n_chars"),
                       F.md5("content").alias("content_md5"))


@query("filter_supported_ext", r"""
    WITH e AS (SELECT page_id, lower(regexp_extract(url, '\.[^./]+$')) AS ext FROM pages)
    SELECT page_id, ext, ext IN ('.pdf', '.docx', '.pptx', '.html', '.htm', '.md') AS supported FROM e""")
def filter_supported_ext(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", tx.suffix(F.col("url")).alias("ext"), documents.supported(F.col("url")).alias("supported"))


@query("csv_row_documents", """
    SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS row,
        'p_partkey: ' || p_partkey || chr(10) || 'p_name: ' || p_name || chr(10) || 'p_brand: ' || p_brand || chr(10)
        || 'p_type: ' || p_type || chr(10) || 'p_size: ' || p_size || chr(10) || 'p_retailprice: ' || p_retailprice
        AS content FROM part""")
def csv_row_documents(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    return documents.rows_to_documents(parts, "p_partkey", integer_bucket("p_partkey"))


HTML_TEXT = r"""replace(replace(replace(replace(replace(replace(replace(replace(replace(
    regexp_replace(regexp_replace(replace(regexp_replace(html,
        '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', '', 'g'), chr(10), ' '),
        '(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|figure|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul)\b[^>]*>',
        chr(10), 'g'), '<[^>]*>', '', 'g'),
    '&nbsp;', ' '), '&middot;', '·'), '&copy;', '©'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&apos;', chr(39)), '&amp;', '&')"""


@query("html_text_blocks", f"""
    WITH b AS (SELECT page_id, list_filter(list_transform(string_split({HTML_TEXT}, chr(10)),
        lambda x: {q.strip('x')}), lambda x: x <> '') AS l FROM pages)
    SELECT page_id, unnest(range(len(l))) AS block_index, unnest(l) AS block FROM b""")
def html_text_blocks(spark, sf):
    return documents.text_blocks(wide(spark, sf, "pages", "page_id", "html")).withColumn("block_index", F.col("block_index").cast("long"))


@query("paragraph_join", f"""
    WITH p AS (SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)),
        lambda x: {q.strip('x')}), lambda x: x <> ''), chr(10) || chr(10)) AS content FROM documents)
    SELECT doc_id, content FROM p WHERE content <> ''""")
def paragraph_join(spark, sf):
    return documents.join_paragraphs(wide(spark, sf, "documents", "doc_id", "text")).select("doc_id", "content")


@query("scan_layout_glob", """
    SELECT lang AS folder, sum(octet_length(encode(text)) + 1)::BIGINT AS n_bytes FROM documents GROUP BY lang""")
def scan_layout_glob(spark, sf):
    root = scratch_path(spark, "layout")
    docs = table(spark, sf, "documents").select("text", "lang")
    docs.write.partitionBy("lang").text(root)
    found = documents.scan_layout(spark, root, "*/*.txt")
    folder = F.regexp_extract("path", r"lang=([^/]+)/", 1)
    return found.groupBy(folder.alias("folder")).agg(F.sum("length").alias("n_bytes"))


@query("path_ids", r"""
    SELECT page_id, string_split(url, '/')[-3] AS doc_id,
        regexp_replace(string_split(url, '/')[-1], '\.[^.]*$', '') AS item_id FROM pages""")
def path_ids(spark, sf):
    return documents.with_path_ids(table(spark, sf, "pages"), "url").select("page_id", "doc_id", "item_id")


@query("chat_jsonl_scan", """
    SELECT conv_id, count(*) AS n_messages,
        string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS transcript FROM conversations GROUP BY conv_id""")
def chat_jsonl_scan(spark, sf):
    out = scratch_path(spark, "chat")
    dialogue.threads(table(spark, sf, "conversations")).write.json(out)
    chat = records.read_chat(spark, out, "conv_id BIGINT")
    return chat.select("conv_id", F.size("messages").cast("long").alias("n_messages"),
                       dialogue.transcript("messages").alias("transcript"))


@query("chat_blocks_scan", """
    WITH p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place FROM conversations)
    SELECT conv_id, place // 4 AS block, count(*) AS n_messages,
        string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS transcript FROM p GROUP BY ALL""", ints="block")
def chat_blocks_scan(spark, sf):
    out = scratch_path(spark, "chat")
    dialogue.thread_blocks(table(spark, sf, "conversations"), 4).write.json(out)
    chat = records.read_chat(spark, out, "conv_id BIGINT, block INT")
    return chat.select("conv_id", "block", F.size("messages").cast("long").alias("n_messages"),
                       dialogue.transcript("messages").alias("transcript"))


@query("golden_scan", f"""
    SELECT row_number() OVER (ORDER BY item_id) - 1 AS idx, text AS question, {q.preview('text', 80)} AS answer,
        'DOC-' || item_id || ' | Clause 1' AS grounding_reference FROM benchmark""")
def golden_scan(spark, sf):
    out = scratch_path(spark, "golden")
    # Files are named in the order of the ranges they hold, so the place of an item is known.
    table(spark, sf, "benchmark").repartitionByRange("item_id").sortWithinPartitions("item_id").select(
        F.col("text").alias("question"), tx.preview(F.col("text"), 80).alias("answer"),
        F.concat(F.lit("DOC-"), "item_id", F.lit(" | Clause 1")).alias("grounding_reference"),
    ).write.options(**writers.CSV).csv(out)
    return records.read_golden(spark, out).select("idx", "question", "answer", "grounding_reference")


@query("eval_results_scan", """
    SELECT doc_id AS idx, md5(text) AS prediction_md5, length(text) AS n_chars, source AS sources FROM documents""")
def eval_results_scan(spark, sf):
    out = scratch_path(spark, "eval")
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("idx"), F.col("lang").alias("question"), F.col("source").alias("ground_truth"),
        F.col("text").alias("prediction"), F.lit(0.5).alias("rougeL_f1"), F.col("source").alias("sources"),
        F.lit("").alias("contexts_joined"))
    writers.write_eval(docs, out)
    return records.read_eval(spark, out).select(
        "idx", F.md5("prediction").alias("prediction_md5"), F.length("prediction").cast("long").alias("n_chars"), "sources")


@query("nested_csv_scan", """
    SELECT s_suppkey, s_name, s_nationkey::BIGINT AS s_nationkey, s_acctbal FROM supplier""")
def nested_csv_scan(spark, sf):
    out = scratch_path(spark, "nested")
    table(spark, sf, "supplier").select(
        "s_suppkey", F.col("s_name").alias("place.name"), F.col("s_nationkey").alias("place.nation"),
        F.col("s_acctbal").alias("money.balance")).write.options(header=True).csv(out)
    flat = spark.read.schema(
        "s_suppkey BIGINT, `place.name` STRING, `place.nation` BIGINT, `money.balance` DOUBLE").csv(out, header=True)
    return documents.nest_columns(flat).select(
        "s_suppkey", F.col("place.name").alias("s_name"), F.col("place.nation").alias("s_nationkey"),
        F.col("money.balance").alias("s_acctbal"))


@query("organ_support_explode", """
    SELECT p_partkey, unnest([p_name || ' (' || p_brand || ', ' || p_type || ')', 'size ' || p_size,
        p_name || ' (' || p_type || ')']) AS item FROM part""")
def organ_support_explode(spark, sf):
    listed = F.concat("p_name", F.lit(" ("), "p_brand", F.lit(", "), "p_type", F.lit("), size "), "p_size",
                      F.lit(",  "), "p_name", F.lit(" ("), "p_type", F.lit(")"))
    return documents.explode_list(table(spark, sf, "part").select("p_partkey", listed.alias("l")), "l").select(
        "p_partkey", "item")


@query("image_data_url", """
    WITH p AS (SELECT page_id, ['png', 'jpg', 'jpeg', 'webp'][page_id % 4 + 1] AS ext, html FROM pages)
    SELECT page_id, 'page_' || page_id || '.' || ext AS path,
        'data:image/' || CASE ext WHEN 'jpg' THEN 'jpeg' ELSE ext END || ';base64,' || base64(encode(html)) AS data_url
    FROM p""")
def image_data_url(spark, sf):
    ext = F.element_at(F.array(*[F.lit(e) for e in ("png", "jpg", "jpeg", "webp")]),
                       (F.col("page_id") % 4 + 1).cast("int"))
    images = wide(spark, sf, "pages", "page_id", "html").select(
        "page_id", F.concat(F.lit("page_"), "page_id", F.lit("."), ext).alias("path"),
        F.encode("html", "UTF-8").alias("content"))
    return documents.with_data_url(images).select("page_id", "path", "data_url")


@query("head_percent", """
    WITH r AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS rn, count(*) OVER () AS n FROM orders)
    SELECT o_orderkey, o_custkey, o_totalprice FROM r WHERE rn <= round(n * 1 / 100.0)""")
def head_percent(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return numbering.head_percent(orders, 1, "o_orderkey")
