"""Projections, filters and scalar functions."""

from pyspark.sql import functions as F

from docloom import fixed_values as V
from docloom.functions import text as tx
from docloom.operators import context, dialogue, ensemble, evaluation, measure
from docloom.queries import frames
from docloom.queries import sqltext as q
from docloom.session import scratch_path
from docloom.queries.registry import query, table, wide

EMAIL = "Write an email.\n\nTopic: {topic}\nTone: {tone}\nAudience: {audience}\n\nEmail:"


@query("tag_modality", "WITH" + q.HITS + """
    SELECT query_id, vec_id, rank, 'text' AS modality, score AS retrieval_score FROM hits""", ints="rank")
def tag_modality(spark, sf):
    return ensemble.tag(frames.hits(spark, sf), "text").select("query_id", "vec_id", "rank", "modality", "retrieval_score")


@query("preview_220", f"SELECT doc_id, {q.preview('text')} AS preview FROM documents")
def preview_220(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.preview(F.col("text")).alias("preview"))


SAFE = f"regexp_replace(replace({q.strip('text')}, chr(13), ''), chr(10) || '{{3,}}', chr(10) || chr(10), 'g')"


@query("safe_preview", f"""
    WITH t AS (SELECT doc_id, {SAFE} AS t FROM documents)
    SELECT doc_id, substr(t, 1, 600) || CASE WHEN length(t) > 600 THEN '…' ELSE '' END AS preview FROM t""")
def safe_preview(spark, sf):
    return wide(spark, sf, "documents", "doc_id", "text").select("doc_id", tx.safe_preview(F.col("text")).alias("preview"))


@query("truncate_display", """
    SELECT doc_id, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS shown FROM documents""")
def truncate_display(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.ellipsis(F.col("text")).alias("shown"))


@query("normalize_text", f"SELECT doc_id, {q.normalized('text')} AS normalized FROM documents")
def normalize_text(spark, sf):
    return wide(spark, sf, "documents", "doc_id", "text").select("doc_id", tx.normalize(F.col("text")).alias("normalized"))


@query("coalesce_identity", "WITH" + q.METADATA + """
    SELECT row_id, coalesce(nullif(chunk_uid, ''), nullif(vector_id, ''), nullif(id, ''), 'N/A') AS chunk_ref,
        coalesce(nullif(doc_id, ''), 'N/A') AS doc_ref FROM meta""")
def coalesce_identity(spark, sf):
    return frames.metadata(spark, sf).select(
        "row_id", ensemble.chunk_ref().alias("chunk_ref"), tx.first_filled(F.col("doc_id"), default="N/A").alias("doc_ref"))


@query("source_hint", "WITH" + q.METADATA + """
    SELECT row_id, coalesce(nullif(source_docx, ''), nullif(source_csv, ''), nullif(source_image, ''), 'N/A') AS hint
    FROM meta""")
def source_hint(spark, sf):
    return frames.metadata(spark, sf).select("row_id", ensemble.source_hint().alias("hint"))


@query("metadata_subset", """
    SELECT doc_id, lang, source, NULL::VARCHAR AS chunk_uid, 'lang,source' AS kept_keys FROM documents""")
def metadata_subset(spark, sf):
    extra = F.create_map(F.lit("lang"), "lang", F.lit("n_chars"), F.col("n_chars").cast("string"), F.lit("source"), "source")
    keys = ["lang", "source", "chunk_uid"]
    kept = context.metadata_subset(extra, keys)
    return table(spark, sf, "documents").select("doc_id", kept.alias("m")).select(
        "doc_id", *[F.col("m")[k].alias(k) for k in keys],
        F.array_join(F.array_sort(F.map_keys("m")), ",").alias("kept_keys"))


RENDER_SAFE = SAFE.replace("text", "content")


@query("render_chunk", "WITH" + q.METADATA + f""",
    rows AS (SELECT row_id, 'text' AS modality, content, NULL AS summary,
               'chunk_id=' || coalesce(nullif(chunk_uid, ''), nullif(vector_id, ''), nullif(id, ''), 'N/A')
               || ' | modality=text | doc_id=' || doc_id || ' | score=None' AS head FROM meta
             UNION ALL
             SELECT page_id, 'image_vlm', html, CASE WHEN page_id % 5 <> 0
               THEN regexp_extract(html, '<title>([^<]*)</title>', 1) END,
               'chunk_id=N/A | modality=image_vlm | doc_id=' || page_id || ' | score=None' FROM pages),
    safe AS (SELECT *, {RENDER_SAFE} AS t FROM rows)
    SELECT row_id, modality, CASE WHEN summary IS NOT NULL
        THEN head || chr(10) || {q.strip("'summary: ' || summary")} || chr(10) || 'key_text: ' || 'url; page' || chr(10) || 'warnings: (none)'
        ELSE head || chr(10) || substr(t, 1, 900) || CASE WHEN length(t) > 900 THEN '…' ELSE '' END END AS rendered
    FROM safe""")
def render_chunk(spark, sf):
    texts = frames.metadata(spark, sf).withColumn("modality", F.lit("text"))
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    record = F.to_json(F.struct(title.alias("summary"), F.array(F.lit("url"), F.lit("page")).alias("key_text")))
    images = wide(spark, sf, "pages", "page_id", "html").select(
        F.col("page_id").alias("row_id"), F.col("page_id").cast("string").alias("doc_id"),
        F.lit("image_vlm").alias("modality"), F.when(F.col("page_id") % 5 != 0, record).otherwise(F.col("html")).alias("content"))
    rows = ensemble.union_hits(texts, images).withColumn("retrieval_score", F.lit(None).cast("double"))
    return rows.select("row_id", "modality", context.render_chunk().alias("rendered"))


@query("json_payload_extract", """
    WITH p AS (SELECT page_id, url, page_id % 5 <> 0 AS ok, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages)
    SELECT page_id, CASE WHEN ok THEN 'screenshot' END AS type, CASE WHEN ok THEN title END AS summary, CASE WHEN ok THEN 'url;page' END AS key_text,
        CASE WHEN ok THEN url || '=site' END AS entities, CASE WHEN ok THEN 'id:' || page_id || ':count' END AS numbers,
        CASE WHEN ok AND page_id % 2 = 0 THEN 'blurred' END AS warnings, NOT ok AS malformed FROM p""")
def json_payload_extract(spark, sf):
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    record = F.to_json(F.struct(
        F.lit("screenshot").alias("type"), title.alias("summary"), F.array(F.lit("url"), F.lit("page")).alias("key_text"),
        F.array(F.struct(F.col("url").alias("name"), F.lit("site").alias("role"))).alias("entities"),
        F.array(F.struct(F.lit("id").alias("label"), F.col("page_id").cast("string").alias("value"), F.lit("count").alias("unit"))).alias("numbers"),
        F.when(F.col("page_id") % 2 == 0, F.array(F.lit("blurred"))).alias("warnings")))
    content = F.when(F.col("page_id") % 5 != 0, record).otherwise(F.concat(F.lit("{not a record: "), "html"))
    p = context.readable_payload(F.col("content"))
    rows = wide(spark, sf, "pages", "page_id", "url", "html").select("page_id", content.alias("content")).select("page_id", p.alias("p"))

    def joined(name, show):
        return F.when(F.col("p")[name].isNotNull(), F.array_join(F.transform(F.col("p")[name], show), ";")).alias(name)

    return rows.select(
        "page_id", "p.type", "p.summary", joined("key_text", lambda k: k), joined("entities", lambda e: F.concat(e["name"], F.lit("="), e["role"])),
        joined("numbers", lambda n: F.concat_ws(":", n["label"], n["value"], n["unit"])), joined("warnings", lambda w: w),
        F.col("p").isNull().alias("malformed"))


@query("json_text", """
    SELECT doc_id, to_json({doc_id: doc_id, lang: lang, source: source, n_chars: n_chars})::VARCHAR AS body FROM documents""")
def json_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", context.json_text("doc_id", "lang", "source", "n_chars").alias("body"))


@query("query_filter_exit", f"""
    WITH c AS (SELECT conv_id, turn, {q.strip("CASE WHEN role = 'system' THEN ' Quit ' ELSE '  ' || text || ' ' END")} AS query
        FROM conversations)
    SELECT * FROM c WHERE lower(query) NOT IN ('exit', 'quit')""")
def query_filter_exit(spark, sf):
    raw = F.when(F.col("role") == "system", " Quit ").otherwise(F.concat(F.lit("  "), "text", F.lit(" ")))
    asked = table(spark, sf, "conversations").select("conv_id", "turn", tx.strip(raw).alias("query"))
    return context.drop_control_words(asked)


@query("tokenize_words", f"""
    WITH w AS (SELECT doc_id, {q.words('text')} AS w FROM documents)
    SELECT doc_id, len(w) AS n_tokens, md5(array_to_string(w, ' ')) AS tokens_md5 FROM w""")
def tokenize_words(spark, sf):
    return wide(spark, sf, "documents", "doc_id", "text").select("doc_id", tx.tokens(F.col("text")).alias("w")).select(
        "doc_id", F.size("w").cast("long").alias("n_tokens"), F.md5(F.array_join("w", " ")).alias("tokens_md5"))


@query("fixed_length_sequences", f"""
    WITH w AS (SELECT doc_id, {q.words('text')} AS w FROM documents),
    vocab AS (SELECT word, row_number() OVER (ORDER BY n DESC, word) + 1 AS id
        FROM (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM w) GROUP BY word)),
    e AS (SELECT doc_id, unnest(w[1:128]) AS word, generate_subscripts(w[1:128], 1) AS pos FROM w),
    s AS (SELECT doc_id, list(id ORDER BY pos) AS ids FROM e JOIN vocab USING (word) GROUP BY doc_id)
    SELECT doc_id, array_to_string(list_concat(coalesce(ids, []), list_transform(range(128 - len(coalesce(ids, []))), lambda x: 0)), ' ') AS input_ids,
        len(coalesce(ids, [])) AS n_attended FROM documents LEFT JOIN s USING (doc_id)""")
def fixed_length_sequences(spark, sf):
    docs = wide(spark, sf, "documents", "doc_id", "text")
    coded = dialogue.fixed_sequences(docs, dialogue.vocabulary(docs))
    return coded.select("doc_id", F.array_join(F.transform("input_ids", lambda x: x.cast("string")), " ").alias("input_ids"),
                        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("long").alias("n_attended"))


@query("prompt_render", """
    SELECT p_partkey, 'Write an email.' || chr(10) || chr(10) || 'Topic: ' || p_name || chr(10) || 'Tone: professional'
        || chr(10) || 'Audience: ' || p_type || chr(10) || chr(10) || 'Email:' AS prompt FROM part""")
def prompt_render(spark, sf):
    filled = tx.fill_template(EMAIL, {"topic": F.col("p_name"), "tone": F.lit("professional"), "audience": F.col("p_type")})
    return table(spark, sf, "part").select("p_partkey", filled.alias("prompt"))


HIT_CONTEXT = q.HITS + """,
    ctx AS (SELECT query_id, 'Which text of label ' || query_id || ' fits best?' AS question,
        string_agg('[Context ' || rank || ']' || chr(10) || content, chr(10) || chr(10) ORDER BY rank) AS context
      FROM hits WHERE rank <= 3 GROUP BY query_id)"""
CONTEXT_FIRST = f"""(chr(10) || 'Answer the question using ONLY the context below.' || chr(10)
    || 'If the context does not contain the answer, say:' || chr(10) || '"{V.FALLBACK_BASIC.replace("'", "''")}"' || chr(10) || chr(10)
    || 'Context:' || chr(10) || context || chr(10) || chr(10) || 'Question:' || chr(10) || question || chr(10) || chr(10)
    || 'Answer:' || chr(10))"""
QUESTION_FIRST = f"""(chr(10) || 'Answer the question using ONLY the context below.' || chr(10)
    || 'If the answer is not in the context, say: "{V.FALLBACK_EVAL.replace("'", "''")}"' || chr(10) || chr(10)
    || 'Question:' || chr(10) || question || chr(10) || chr(10) || 'Context:' || chr(10) || context || chr(10) || chr(10)
    || 'Answer:' || chr(10))"""


def hit_contexts(spark, sf):
    contexts = context.build_context(frames.hits(spark, sf, 3), "numbered")
    return contexts.withColumn("question", F.concat(F.lit("Which text of label "), "query_id", F.lit(" fits best?")))


@query("rag_prompt", "WITH" + HIT_CONTEXT + f"""
    SELECT query_id, {CONTEXT_FIRST} AS context_first, {QUESTION_FIRST} AS question_first, question AS plain FROM ctx""")
def rag_prompt(spark, sf):
    return hit_contexts(spark, sf).select("query_id", *[
        context.rag_prompt(s, F.col("question"), F.col("context")).alias(s)
        for s in ("context_first", "question_first", "plain")])


@query("strip_prompt_echo", f"SELECT conv_id, turn, {q.strip('text')} AS answer FROM conversations")
def strip_prompt_echo(spark, sf):
    prompt = F.concat(F.lit("Question from "), "role", F.lit(":\n"))
    echoed = table(spark, sf, "conversations").select(
        "conv_id", "turn", prompt.alias("prompt"), F.concat(prompt, F.lit("\n "), "text", F.lit(" \n")).alias("output"))
    return echoed.select("conv_id", "turn", tx.strip_echo(F.col("output"), F.col("prompt")).alias("answer"))


DISCOUNT_INPUT = """CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN l_extendedprice::VARCHAR
    WHEN l_returnflag = 'R' AND l_linenumber = 2 THEN l_extendedprice || ',ten'
    ELSE l_extendedprice || ' , ' || round(l_discount * 100)::INT END"""


@query("discount_parse", f"""
    WITH i AS (SELECT l_orderkey, l_linenumber, {DISCOUNT_INPUT} AS input_text, l_extendedprice AS p,
        round(l_discount * 100)::DOUBLE AS d FROM lineitem)
    SELECT l_orderkey, l_linenumber, input_text, CASE WHEN contains(input_text, ' , ')
        THEN 'Final price after ' || d || '% discount is ' || round((p * (1 - d / 100))::DECIMAL(38,10), 2)::DECIMAL(38,2)
        WHEN contains(input_text, ',') THEN 'Invalid input. Use ''price,discount''. Error: could not convert string to float: ''ten' || chr(39)
        ELSE 'Invalid input. Use ''price,discount''. Error: not enough values to unpack (expected 2, got 1)' END AS answer FROM i""")
def discount_parse(spark, sf):
    price, returned = F.col("l_extendedprice").cast("string"), F.col("l_returnflag") == "R"
    text = (F.when(returned & (F.col("l_linenumber") == 1), price)
            .when(returned & (F.col("l_linenumber") == 2), F.concat(price, F.lit(",ten")))
            .otherwise(F.concat(price, F.lit(" , "), F.round(F.col("l_discount") * 100).cast("int"))))
    return wide(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_returnflag").select("l_orderkey", "l_linenumber", text.alias("input_text")).withColumn(
        "answer", tx.discount_text(F.col("input_text")))


STAGES = "['chat', 'embeddings', 'vlm', 'audio'][event_id % 4 + 1]"


@query("cost_estimate", f"""
    WITH e AS (SELECT event_id, {STAGES} AS stage, CASE WHEN event_id % 3 <> 0 THEN (props->>'$.k')::BIGINT END AS i,
        CASE WHEN event_id % 5 <> 0 THEN floor(value)::BIGINT END AS o FROM events)
    SELECT event_id, stage, i AS input_tokens, o AS output_tokens,
        CASE WHEN i IS NULL AND o IS NULL THEN NULL WHEN stage = 'chat' THEN 'chat_cost_per_1k_input=0.001,chat_cost_per_1k_output=0.001'
             WHEN stage = 'embeddings' THEN 'embed_cost_per_1k_input=0.0001' WHEN stage = 'vlm' THEN 'vlm_cost_per_1k_input=0.005,vlm_cost_per_1k_output=0.005' END AS rates_used,
        CASE WHEN i IS NULL AND o IS NULL THEN 'Token counts not available from this call path.'
             WHEN stage = 'audio' THEN 'Unknown stage ''audio''.' END AS note,
        round(CASE WHEN i IS NULL AND o IS NULL THEN NULL
             WHEN stage = 'chat' THEN coalesce(i, 0) / 1000.0 * 0.001 + coalesce(o, 0) / 1000.0 * 0.001
             WHEN stage = 'embeddings' THEN coalesce(i, 0) / 1000.0 * 0.0001
             WHEN stage = 'vlm' THEN coalesce(i, 0) / 1000.0 * 0.005 + coalesce(o, 0) / 1000.0 * 0.005 END::DOUBLE, 9) AS cost_usd
    FROM e""")
def cost_estimate(spark, sf):
    stage = F.element_at(F.array(*[F.lit(s) for s in ("chat", "embeddings", "vlm", "audio")]),
                         (F.col("event_id") % 4 + 1).cast("int"))
    events = table(spark, sf, "events").select(
        "event_id", stage.alias("stage"),
        F.when(F.col("event_id") % 3 != 0, F.get_json_object("props", "$.k").cast("long")).alias("input_tokens"),
        F.when(F.col("event_id") % 5 != 0, F.floor("value").cast("long")).alias("output_tokens"))
    listed = F.transform(F.array_sort(F.map_entries("rates_used")), lambda e: F.concat(e["key"], F.lit("="), F.regexp_replace(
        F.format_string("%.4f", e["value"]), "0+$", "")))
    return measure.estimate_cost(events).withColumn("rates_used", F.array_join(listed, ",")).withColumn("cost_usd", F.round("cost_usd", 9))


@query("round_timing", """
    SELECT event_id, CASE WHEN event_type <> 'error' THEN round((value + value / 7) - value, 4) END AS seconds FROM events""")
def round_timing(spark, sf):
    value = F.col("value")
    return table(spark, sf, "events").select("event_id", measure.duration(
        value, value + value / 7, F.col("event_type") != "error").alias("seconds"))


@query("size_mb", """
    SELECT doc_id, round(octet_length(encode(text)) * 100 / (1024.0 * 1024.0), 2)::DOUBLE AS size_mb FROM documents""")
def size_mb(spark, sf):
    return table(spark, sf, "documents").select("doc_id", measure.size_mb(F.octet_length("text") * 100).alias("size_mb"))


PAIRED = """
    pr AS (SELECT user_id, avg(value) FILTER (WHERE event_type = 'view') AS base,
        avg(value) FILTER (WHERE event_type = 'click') AS variant
      FROM events WHERE event_type IN ('view', 'click') GROUP BY user_id)"""


@query("improvement_pct", "WITH" + PAIRED + """
    SELECT user_id, round((base - variant) / base * 100, 1) AS improvement_pct, round(base - variant, 6) AS reduction FROM pr""")
def improvement_pct(spark, sf):
    both = measure.pair(table(spark, sf, "events"), ["user_id"], "event_type", "value", "view", "click")
    return both.select("user_id", measure.improvement(F.col("base"), F.col("variant")).alias("improvement_pct"),
                       F.round(F.col("base") - F.col("variant"), 6).alias("reduction"))


@query("keyword_accuracy", """
    SELECT doc_id, round(len(list_filter(['the', 'and', 'der', 'que'], lambda k: contains(lower(text), k))) / 4.0::DOUBLE, 6)
        AS accuracy FROM documents""")
def keyword_accuracy(spark, sf):
    words = F.array(*[F.lit(w) for w in ("the", "and", "der", "que")])
    return wide(spark, sf, "documents", "doc_id", "text").select("doc_id", F.round(tx.keyword_share(F.col("text"), words), 6).alias("accuracy"))


VERDICT = "'FINAL_SCORE:' || CASE WHEN event_type = 'error' THEN '' ELSE ' ' END || round(value / 10, 1)::DOUBLE"


@query("pass_by_score_text", f"""
    WITH e AS (SELECT event_id, {VERDICT} AS evaluation FROM events)
    SELECT event_id, contains(evaluation, 'FINAL_SCORE: 8') OR contains(evaluation, 'FINAL_SCORE: 9')
        OR contains(evaluation, 'FINAL_SCORE: 10') AS passed FROM e""")
def pass_by_score_text(spark, sf):
    gap = F.when(F.col("event_type") == "error", "").otherwise(" ")
    text = F.concat(F.lit("FINAL_SCORE:"), gap, F.round(F.col("value") / 10, 1).cast("string"))
    return table(spark, sf, "events").select("event_id", evaluation.passed_by_text(text).alias("passed"))


@query("score_parse", """
    SELECT event_id, round(value / 10, 1)::DOUBLE AS relevance, (user_id % 11)::DOUBLE AS clarity,
        CASE WHEN event_type <> 'error' THEN ((props->>'$.k')::BIGINT % 11)::DOUBLE END AS completeness,
        NULL::DOUBLE AS feasibility FROM events""")
def score_parse(spark, sf):
    k = F.get_json_object("props", "$.k").cast("long") % 11
    text = F.concat(
        F.lit("Relevance: "), F.round(F.col("value") / 10, 1), F.lit("\nclarity:"), F.col("user_id") % 11,
        F.when(F.col("event_type") != "error", F.concat(F.lit("\nCompleteness: "), k)).otherwise(""),
        F.lit("\nFeasibility: good"))
    return table(spark, sf, "events").select("event_id", *tx.rubric_scores(text, V.RUBRIC_DIMENSIONS))


@query("message_parts_text", """
    SELECT conv_id, turn, trim(array_to_string(list_filter(string_split(text, chr(10)), lambda t: t <> ''), chr(10)), ' ' || chr(10))
        AS message FROM conversations""")
def message_parts_text(spark, sf):
    parts = F.transform(F.split("text", "\n"), lambda t: F.struct(F.lit("text").alias("type"), t.alias("text")))
    return table(spark, sf, "conversations").select("conv_id", "turn", tx.message_text(parts).alias("message"))
