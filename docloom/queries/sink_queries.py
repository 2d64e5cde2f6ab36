"""Sinks: write to a fresh folder, read back, return the frame."""

from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.operators import chunking, collection, measure
from docloom.operators.numbering import integer_bucket
from docloom.plans import run
from docloom.queries import frames
from docloom.queries import sqltext as q
from docloom.queries.registry import query, table
from docloom.session import scratch_path
from docloom.sinks import writers
from docloom.sources import records


@query("sink_table_export", """
    SELECT 'orders' AS doc_id, substr(o_orderpriority, 1, 1)::INT AS table_index,
        'orders__table_00' || substr(o_orderpriority, 1, 1) AS sql_table, count(*) AS rows, 3 AS cols,
        count(*) AS rows_in_csv, round(sum(o_totalprice), 2) AS total_in_sql FROM orders GROUP BY ALL""")
def sink_table_export(spark, sf):
    out = scratch_path(spark, "tables")
    orders = table(spark, sf, "orders").select(
        F.lit("orders").alias("doc_id"), F.substring("o_orderpriority", 1, 1).cast("int").alias("table_index"),
        "o_orderkey", "o_custkey", "o_totalprice")
    # Two exports in a row: the second adds its tables and leaves the others.
    first = F.col("table_index") < 3
    one, two = writers.export_tables(orders.where(first), out), writers.export_tables(orders.where(~first), out)
    index = one.union(two)
    csv = spark.read.csv(f"{out}/csv", header=True).groupBy("doc_id", "table_index").agg(
        F.count(F.lit(1)).alias("rows_in_csv"))
    sql = spark.read.parquet(f"{out}/sql").groupBy("doc_id", "table_index").agg(
        F.round(F.sum("o_totalprice"), 2).alias("total_in_sql"))
    return index.join(csv, ["doc_id", "table_index"]).join(sql, ["doc_id", "table_index"])


@query("sink_manifest", "WITH" + q.windows(500, 50) + """
    SELECT doc_id, chunk_index // 20 AS part, count(*) AS n_entries,
        string_agg(chunk_index || ':' || length(content), ',' ORDER BY chunk_index) AS entries FROM chunks GROUP BY ALL""", ints="part")
def sink_manifest(spark, sf):
    out = scratch_path(spark, "manifest")
    chunks = frames.fixed_chunks(spark, sf).withColumn("n_chars", F.length("content"))
    writers.write_json(writers.manifest(chunks, "doc_id", ["chunk_index", "n_chars"], 20), out)
    back = spark.read.schema(
        "doc_id BIGINT, part INT, n_entries BIGINT, entries ARRAY<STRUCT<chunk_index: INT, n_chars: INT>>").json(out)
    shown = F.array_join(F.transform("entries", lambda e: F.concat(e["chunk_index"], F.lit(":"), e["n_chars"])), ",")
    return back.select("doc_id", "part", "n_entries", shown.alias("entries"))


@query("item_manifests", """
    WITH t AS (SELECT o_orderpriority AS item, count(*) AS n FROM orders GROUP BY 1)
    SELECT 'tables' AS collection, item, (CASE WHEN n <= 20 THEN 1 ELSE 1 + ceil((n - 20) / 17.0) END)::BIGINT AS n_chunks FROM t
    UNION ALL SELECT 'images', regexp_replace(string_split(url, '/')[-1], '\\.[^.]*$', ''), count(*) FROM pages GROUP BY 2""")
def item_manifests(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey")
    rows = chunking.chunk_rows(orders, ["o_orderpriority"], ["o_orderkey"], integer_bucket("o_orderkey"))
    first = rows.where(F.col("row_number") == F.col("row_start")).select(F.col("o_orderpriority").alias("item"), F.lit(1).cast("long").alias("n"))
    images = table(spark, sf, "pages").select(tx.stem(F.col("url")).alias("item"), F.lit(1).cast("long").alias("n"))
    return writers.item_manifest(first, "tables", ["item"], "n").union(writers.item_manifest(images, "images", ["item"], "n"))


@query("sink_union_keys_csv", """
    SELECT NULL AS acctbal, c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_acctbal, s_suppkey, s_name, NULL FROM supplier""")
def sink_union_keys_csv(spark, sf):
    out = scratch_path(spark, "union")
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal"))
    writers.write_union_csv([customers, suppliers], out)
    return spark.read.schema("acctbal DOUBLE, key BIGINT, name STRING, segment STRING").csv(out, header=True)


@query("sink_text_dump", "WITH" + q.HITS + """
    SELECT query_id, chr(10) || chr(10) || string_agg('[' || rank || '] source=' || source || ' | faiss_distance='
        || printf('%.6f', score) || ' | rerank=None' || chr(10) || content, repeat('-', 80) || chr(10) || chr(10)
        ORDER BY rank) || chr(10) AS dump FROM hits WHERE rank <= 3 GROUP BY query_id""")
def sink_text_dump(spark, sf):
    out = scratch_path(spark, "dump")
    hits = frames.hits(spark, sf, 3).withColumn("rerank_score", F.lit(None).cast("double"))
    writers.write_text(writers.candidate_dump(hits), out, "dump", ["query_id"])
    return spark.read.option("pathGlobFilter", "*.txt").text(out, wholetext=True).select(
        "query_id", F.col("value").alias("dump"))


@query("sink_run_dirs", "WITH" + q.HITS + f"""
    SELECT printf('q_%03d', query_id) AS q_idx, rank, source, score AS faiss_distance,
        {q.preview('content')} AS preview FROM hits WHERE rank <= 3""", ints="rank")
def sink_run_dirs(spark, sf):
    base = scratch_path(spark, "runs")
    rows = frames.hits(spark, sf, 3).select(
        writers.question_folder(F.col("query_id")).alias("q_idx"), "rank", "source",
        F.col("score").alias("faiss_distance"), tx.preview(F.col("content")).alias("preview"))
    out = writers.write_run(rows, base, "0001", "candidates", ["q_idx"])
    return spark.read.schema(
        "rank INT, source STRING, faiss_distance DOUBLE, preview STRING, q_idx STRING").json(out)


@query("sink_artifacts", "WITH" + q.ENSEMBLE + """,
    raw AS (SELECT query_id, any_value(question) AS question, string_agg(ensemble_rank || ':' || modality || ':' || chunk_id, ',' ORDER BY ensemble_rank) AS raw,
        count(*) AS n_raw, count(*) FILTER (NOT repeat) AS n_cited, coalesce(string_agg(chunk_id, ',' ORDER BY ensemble_rank) FILTER (repeat), '') AS removed
      FROM ehits GROUP BY query_id)
    SELECT 'q_' || query_id AS q_idx, raw, n_raw AS n_rendered, removed, n_cited, true AS asked, true AS answered, question AS traced, n_raw AS traced_raw,
        true AS timed FROM raw""")
def sink_artifacts(spark, sf):
    out = run.run_questions(frames.questions(spark, sf), frames.stored_collection(spark, sf), scratch_path(spark, "runs"), "0001")
    found = writers.read_artifacts(spark, out).groupBy("q_idx").pivot("artifact", [*writers.ARTIFACTS, "trace.json"]).agg(F.first("body"))
    of = lambda name: F.col(f"`{name}`")
    line = F.from_csv("line", ", ".join(f"{c} STRING" for c in writers.RAW_COLUMNS), {"quote": '"', "escape": '"'})
    rows = found.select("q_idx", F.explode(F.slice(F.split(of("retrieval_raw.csv"), "\n"), 2, 100)).alias("line")).select("q_idx", line.alias("r"))
    named = F.concat_ws(":", "r.rank", "r.modality", F.coalesce("r.chunk_uid", "r.vector_id"))
    raw = rows.groupBy("q_idx").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("r.rank").cast("int"), named))), lambda x: x["col2"]), ",").alias("raw"))
    trace = F.from_json(of("trace.json"), "query STRING, counts STRUCT<retrieved_raw: BIGINT>, timings_sec STRUCT<retrieval: DOUBLE, dedupe: DOUBLE, "
                        "rerank: DOUBLE, context_build: DOUBLE, llm: DOUBLE, total: DOUBLE>")
    spent = trace["timings_sec"]
    sums = sum((spent[c] for c in ("dedupe", "rerank", "context_build", "llm")), spent["retrieval"])
    gone = F.from_json(of("dedupe_removed.json"), "ARRAY<STRUCT<chunk_id: STRING>>")
    return found.join(raw, "q_idx").select(
        "q_idx", "raw", F.regexp_count(of("retrieval_raw.txt"), F.lit(r"(?m)^chunk_id=[0-9a-f]{24} \| modality=")).cast("long").alias("n_rendered"),
        F.array_join(gone["chunk_id"], ",").alias("removed"),
        F.regexp_count(of("final_context.txt"), F.lit(r"(?m)^\[\d+\] chunk_id=")).cast("long").alias("n_cited"),
        F.contains(of("final_prompt.txt"), trace["query"]).alias("asked"), (F.length(of("answer.txt")) > 0).alias("answered"),
        trace["query"].alias("traced"), trace["counts"]["retrieved_raw"].alias("traced_raw"),
        ((spent["retrieval"] > 0) & (spent["total"] >= sums - 0.001)).alias("timed"))


@query("upsert_collection", """
    SELECT doc_id AS id, md5(text) AS content_md5, 'documents' AS origin FROM documents
    WHERE doc_id NOT IN (SELECT item_id FROM benchmark)
    UNION ALL SELECT item_id, md5(text), 'benchmark' FROM benchmark""")
def upsert_collection(spark, sf):
    existing = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.md5("text").alias("content_md5"), F.lit("documents").alias("origin"))
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text")
    # Every id arrives twice in the batch; the second version has to win.
    incoming = items.select("id", F.explode(F.array(F.lit(1), F.lit(2))).alias("version"), "text").select(
        "id", F.when(F.col("version") == 2, F.md5("text")).otherwise("").alias("content_md5"),
        F.lit("benchmark").alias("origin"), "version")
    return collection.upsert(existing, incoming, "id", "version")


@query("sink_sidecar_json", """
    SELECT page_id, url || '.v1.json' AS sidecar_json, 'screenshot' AS type,
        regexp_extract(html, '<title>([^<]*)</title>', 1) AS summary FROM pages""")
def sink_sidecar_json(spark, sf):
    out = scratch_path(spark, "sidecar")
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    pages = table(spark, sf, "pages").select("page_id", F.col("url").alias("path"), F.struct(
        F.lit("screenshot").alias("type"), title.alias("summary"), "page_id").alias("payload"))
    writers.sidecar_frame(pages, "v1").write.mode("errorifexists").json(out)
    back = spark.read.schema("sidecar_json STRING, body STRING").json(out)
    record = F.from_json("body", "type STRING, summary STRING, page_id BIGINT")
    return back.select(record["page_id"].alias("page_id"), "sidecar_json", record["type"].alias("type"),
                       record["summary"].alias("summary"))


@query("sink_trace", "WITH" + q.ENSEMBLE + """
    SELECT query_id, any_value(question) AS query, 4 AS top_k, 7 AS final_k, true AS rerank, count(*) AS retrieved_raw,
        sum(repeat::INT)::BIGINT AS dedupe_removed, sum((NOT repeat)::INT)::BIGINT AS final_context,
        sum(length(content))::BIGINT AS embedded, round(sum(length(content)) / 1000.0 * 0.0001, 9)::DOUBLE AS embed_cost,
        'Token counts not available from this call path.' AS chat_note, 0.005 AS vlm_rate,
        'run_0001/q_' || query_id || '/answer.txt' AS answer_txt FROM ehits GROUP BY query_id""", ints="top_k final_k")
def sink_trace(spark, sf):
    out = scratch_path(spark, "trace")
    hits = frames.ensemble_hits(spark, sf)
    counts = measure.trace_counts(hits).join(frames.questions(spark, sf), "query_id")
    # Each character of a hit counts as an embedding token; the other stages leave none.
    tokens = hits.select("query_id", F.lit("embeddings").alias("stage"), F.length("content").cast("long").alias("input_tokens"),
                         F.lit(None).cast("long").alias("output_tokens"))
    config = {"TOP_K_PER_MODALITY": 4, "FINAL_CONTEXT_K": 7, "ENABLE_DEDUPE": True, "ENABLE_RERANK": True, "RERANK_TOP_K": 7}
    artifacts = {"answer_txt": "run_0001/q_{query}/answer.txt", "retrieval_raw_csv": "run_0001/q_{query}/retrieval_raw.csv"}
    writers.write_json(writers.trace_frame(counts, config, tokens=tokens, artifacts=artifacts), out)
    back = spark.read.schema(
        "query_id BIGINT, query STRING, config STRUCT<TOP_K_PER_MODALITY: INT, FINAL_CONTEXT_K: INT, ENABLE_RERANK: BOOLEAN>, "
        "counts STRUCT<retrieved_raw: BIGINT, dedupe_removed: BIGINT, final_context: BIGINT>, "
        "cost_placeholders STRUCT<chat: STRUCT<note: STRING>, embeddings: STRUCT<input_tokens: BIGINT, cost_usd: DOUBLE>, "
        "rates_config: STRUCT<vlm_cost_per_1k_output: DOUBLE>>, artifacts STRUCT<answer_txt: STRING>").json(out)
    costs = F.col("cost_placeholders")
    return back.select(
        "query_id", "query", F.col("config.TOP_K_PER_MODALITY").alias("top_k"), F.col("config.FINAL_CONTEXT_K").alias("final_k"),
        F.col("config.ENABLE_RERANK").alias("rerank"), "counts.*", costs["embeddings"]["input_tokens"].alias("embedded"),
        F.round(costs["embeddings"]["cost_usd"], 9).alias("embed_cost"), costs["chat"]["note"].alias("chat_note"),
        costs["rates_config"]["vlm_cost_per_1k_output"].alias("vlm_rate"), "artifacts.answer_txt")


@query("sink_eval_csv", """
    SELECT d.doc_id AS idx, md5(d.text) AS prediction_md5, l.quality::DOUBLE AS answer_relevancy
    FROM documents d LEFT JOIN labels l USING (doc_id)""")
def sink_eval_csv(spark, sf):
    first, second = scratch_path(spark, "eval-a"), scratch_path(spark, "eval-b")
    results = table(spark, sf, "documents").select(F.col("doc_id").alias("idx"), F.col("text").alias("prediction"))
    writers.write_eval(results, first)
    stored = spark.read.schema("idx BIGINT, prediction STRING").csv(first, **records.CSV)
    judged = table(spark, sf, "labels").select(
        F.col("doc_id").alias("idx"), F.col("quality").cast("double").alias("answer_relevancy"))
    writers.write_eval(stored.join(judged, "idx", "left"), second)
    back = spark.read.schema("idx BIGINT, prediction STRING, answer_relevancy DOUBLE").csv(second, **records.CSV)
    return back.select("idx", F.md5("prediction").alias("prediction_md5"), "answer_relevancy")
