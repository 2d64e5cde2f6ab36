"""Evaluation, measurement, dialogue and draft tables."""

from pyspark.sql import functions as F

from docloom.functions import scoring
from docloom.operators import chunking, context, dialogue, evaluation, measure, numbering
from docloom.operators.numbering import integer_bucket
from docloom.queries import frames
from docloom.queries import sqltext as q
from docloom.queries.column_queries import PAIRED
from docloom.queries.registry import query, table, wide

SECTIONS = ["Executive Summary", "Problem Statement", "Proposed Solution", "Timeline"]


@query("merge_metrics", """
    SELECT d.doc_id AS idx, d.source, l.quality::DOUBLE AS answer_relevancy, l.toxic::DOUBLE AS faithfulness
    FROM documents d LEFT JOIN labels l USING (doc_id)""")
def merge_metrics(spark, sf):
    results = table(spark, sf, "documents").select(F.col("doc_id").alias("idx"), "source")
    judged = table(spark, sf, "labels").select(
        F.col("doc_id").alias("idx"), F.col("quality").cast("double").alias("answer_relevancy"),
        F.col("toxic").cast("double").alias("faithfulness"))
    return evaluation.merge_metrics(results, judged)


@query("variant_pair_join", "WITH" + PAIRED + "SELECT user_id, round(base, 6) AS base, round(variant, 6) AS variant FROM pr")
def variant_pair_join(spark, sf):
    both = measure.pair(table(spark, sf, "events"), ["user_id"], "event_type", "value", "view", "click")
    return both.select("user_id", F.round("base", 6).alias("base"), F.round("variant", 6).alias("variant"))


@query("model_question_cross", "SELECT item_id, text AS question, unnest(['base', 'finetuned']) AS model FROM benchmark")
def model_question_cross(spark, sf):
    asked = table(spark, sf, "benchmark").select("item_id", F.col("text").alias("question"))
    return measure.model_questions(asked, ["base", "finetuned"])


SECTION_SQL = "['Executive Summary', 'Problem Statement', 'Proposed Solution', 'Timeline']"


@query("requirement_section_cross", f"""
    SELECT item_id, unnest(range(4)) AS section_order, unnest({SECTION_SQL}) AS section FROM benchmark""")
def requirement_section_cross(spark, sf):
    return dialogue.sections(table(spark, sf, "benchmark").select("item_id"), SECTIONS).withColumn(
        "section_order", F.col("section_order").cast("long"))


@query("golden_prediction_join", """
    SELECT b.item_id AS idx, b.text AS question, md5(d.text) AS prediction_md5 FROM benchmark b JOIN documents d ON d.doc_id = b.item_id""")
def golden_prediction_join(spark, sf):
    golden = table(spark, sf, "benchmark").select(F.col("item_id").alias("idx"), F.col("text").alias("question"))
    predictions = table(spark, sf, "documents").select(F.col("doc_id").alias("idx"), F.md5("text").alias("prediction_md5"))
    return evaluation.attach_predictions(golden, predictions)


GROUNDED = q.HITS + """,
    rel AS (SELECT h.*, starts_with(h.source, 'src' || (h.query_id % 2 + 1))::INT AS relevant FROM hits h)"""


def _grounded(spark, sf):
    golden = frames.centroids(spark, sf).select("query_id", F.concat(
        F.lit("src"), F.col("query_id") % 2 + 1, F.lit(" | Clause "), "query_id").alias("grounding_reference"))
    return evaluation.grounding_hits(frames.hits(spark, sf), golden)


@query("grounding_match", "WITH" + GROUNDED + "SELECT query_id, sum(relevant)::BIGINT AS grounded, count(*) AS retrieved FROM rel GROUP BY query_id")
def grounding_match(spark, sf):
    return _grounded(spark, sf).groupBy("query_id").agg(
        F.sum("relevant").alias("grounded"), F.count(F.lit(1)).alias("retrieved"))


@query("ranked_context_precision", "WITH" + GROUNDED + """,
    p AS (SELECT *, avg(relevant) OVER (PARTITION BY query_id ORDER BY rank) AS p FROM rel)
    SELECT query_id, round(coalesce(sum(p * relevant) / nullif(sum(relevant), 0), 0), 6) AS context_precision FROM p GROUP BY query_id""")
def ranked_context_precision(spark, sf):
    scored = evaluation.context_precision(_grounded(spark, sf))
    return scored.withColumn("context_precision", F.round("context_precision", 6))


@query("model_summary", """
    SELECT event_type, round(avg(event_id), 6) AS event_id, round(avg(user_id), 6) AS user_id, round(avg(value), 6) AS value
    FROM events GROUP BY event_type""")
def model_summary(spark, sf):
    means = measure.summary_by(table(spark, sf, "events"), "event_type")
    return means.select("event_type", *[F.round(c, 6).alias(c) for c in ("event_id", "user_id", "value")])


@query("describe_metric", """
    SELECT count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min,
        round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
        round(quantile_cont(value, 0.75), 6) AS p75, max(value) AS max FROM events""")
def describe_metric(spark, sf):
    return evaluation.describe(table(spark, sf, "events"), "value").select(
        "count", "min", "max", *[F.round(c, 6).alias(c) for c in ("mean", "std", "p25", "p50", "p75")])


@query("numeric_means", """
    SELECT round(avg(p_partkey), 6) AS p_partkey, round(avg(p_size), 6) AS p_size, round(avg(p_retailprice), 6) AS p_retailprice FROM part""")
def numeric_means(spark, sf):
    means = evaluation.numeric_means(table(spark, sf, "part"))
    return means.select(*[F.round(c, 6).alias(c) for c in means.columns])


@query("latency_average", """
    WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS run FROM events)
    SELECT event_type, round(avg(value), 6) AS avg_latency, count(*) AS runs FROM r WHERE run > 1 GROUP BY event_type""")
def latency_average(spark, sf):
    return measure.latency(table(spark, sf, "events"), "event_type", "event_id", "value").withColumn(
        "avg_latency", F.round("avg_latency", 6))


@query("param_counts", """
    SELECT sum(l_quantity)::BIGINT AS total, sum(l_quantity) FILTER (WHERE l_returnflag = 'R')::BIGINT AS trainable,
        round(100.0 * sum(l_quantity) FILTER (WHERE l_returnflag = 'R') / sum(l_quantity), 2)::DOUBLE AS percent FROM lineitem""")
def param_counts(spark, sf):
    items = table(spark, sf, "lineitem")
    return measure.conditional_totals(items, F.col("l_quantity").cast("long"), F.col("l_returnflag") == "R").withColumn(
        "percent", F.col("percent").cast("double"))


@query("manifest_counts", """
    SELECT source, count(*) FILTER (WHERE lang = 'en') AS n_en, count(*) FILTER (WHERE lang = 'fr') AS n_fr,
        count(*) FILTER (WHERE lang = 'de') AS n_de, count(*) FILTER (WHERE lang NOT IN ('en', 'fr', 'de') OR lang IS NULL) AS n_other FROM documents GROUP BY source""")
def manifest_counts(spark, sf):
    return measure.doc_counts(table(spark, sf, "documents"), "source", "lang", ["en", "fr", "de"])


@query("ingest_totals", "WITH" + q.row_chunks("oc", "orders", "o_orderpriority", "o_orderkey", "o_orderkey") + """,
    t AS (SELECT part, count(DISTINCT c) AS n FROM oc GROUP BY part ORDER BY part LIMIT 3)
    SELECT count(*) AS tables_indexed, sum(n)::BIGINT AS chunks_indexed FROM t""")
def ingest_totals(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey")
    rows = chunking.chunk_rows(orders, ["o_orderpriority"], ["o_orderkey"], integer_bucket("o_orderkey"))
    first_rows = rows.where(F.col("row_number") == F.col("row_start"))
    return measure.ingest_totals(first_rows, ["o_orderpriority"], cap=3)


@query("trace_counts", "WITH" + q.ENSEMBLE + """
    SELECT query_id, count(*) AS retrieved_raw, sum(repeat::INT)::BIGINT AS dedupe_removed,
        sum((NOT repeat)::INT)::BIGINT AS final_context FROM ehits GROUP BY query_id""")
def trace_counts(spark, sf):
    return measure.trace_counts(frames.ensemble_hits(spark, sf))


TURNS = f"""
    w AS (SELECT conv_id, turn, {q.words('text')} AS t FROM conversations),
    pr AS (SELECT b.conv_id, b.turn, b.t AS p, a.t AS r FROM w a JOIN w b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"""
def _turn_pairs(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    earlier = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("reference"))
    return turns.withColumnRenamed("text", "prediction").join(earlier, ["conv_id", "turn"])


@query("rouge_l", f"WITH RECURSIVE{TURNS}," + q.lcs("pr", "conv_id, turn") + """
    SELECT conv_id, turn, rouge AS rouge_l FROM scored""")
def rouge_l(spark, sf):
    return _turn_pairs(spark, sf).select(
        "conv_id", "turn", F.round(scoring.rouge_l(F.col("prediction"), F.col("reference")), 6).alias("rouge_l"))


@query("bleu4", f"""
    WITH h AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda t: t <> '') AS r,
        list_filter(regexp_split_to_array(regexp_replace(text, '(?s)^([^\\n]*)\\n(.*)$', '\\2 \\1'), '\\s+'), lambda t: t <> '') AS h FROM documents),
    g AS (SELECT doc_id, n, 'h' AS side, unnest(list_transform(range(1, len(h) - n + 2), lambda i: array_to_string(h[i:i + n - 1], ' '))) AS gram FROM h, range(1, 5) t(n)
      UNION ALL
      SELECT doc_id, n, 'r', unnest(list_transform(range(1, len(r) - n + 2), lambda i: array_to_string(r[i:i + n - 1], ' '))) FROM h, range(1, 5) t(n)),
    m AS (SELECT doc_id, n, least(count(*) FILTER (WHERE side = 'h'), count(*) FILTER (WHERE side = 'r')) AS c FROM g GROUP BY doc_id, n, gram),
    s AS (SELECT doc_id, n, sum(c)::DOUBLE AS c FROM m GROUP BY doc_id, n),
    x AS (SELECT d.doc_id, len(d.h) AS lh, len(d.r) AS lr, n,
        coalesce(s.c, 0) / greatest(1, len(d.h) - n + 1) AS p FROM h d CROSS JOIN range(1, 5) t(n) LEFT JOIN s USING (doc_id, n))
    SELECT doc_id, round(CASE WHEN max(CASE WHEN n = 1 THEN p END) = 0 THEN 0 ELSE
        (CASE WHEN any_value(lh) > any_value(lr) THEN 1 ELSE exp(1 - any_value(lr)::DOUBLE / any_value(lh)) END)
        * exp(sum(ln(CASE WHEN p = 0 THEN 2.2250738585072014e-308 ELSE p END)) / 4) END, 6) AS bleu FROM x GROUP BY doc_id""")
def bleu4(spark, sf):
    # The hypothesis is the document with its first line moved to the end.
    moved = F.regexp_replace("text", r"(?s)\A([^\n]*)\n(.*)\z", "$2 $1")
    return wide(spark, sf, "documents", "doc_id", "text").select(
        "doc_id", F.round(scoring.bleu4(moved, F.col("text")), 6).alias("bleu"))


@query("context_recall_faithfulness", "WITH" + TURNS + """
    SELECT conv_id, turn,
        round(coalesce(len(list_intersect(list_distinct(r), p)) / nullif(len(list_distinct(r)), 0), 0), 6) AS reference_support,
        round(coalesce(len(list_intersect(list_distinct(p), r)) / nullif(len(list_distinct(p)), 0), 0), 6) AS answer_support FROM pr""")
def context_recall_faithfulness(spark, sf):
    p, r = F.col("prediction"), F.col("reference")
    return _turn_pairs(spark, sf).select(
        "conv_id", "turn", F.round(scoring.support_ratio(r, p), 6).alias("reference_support"),
        F.round(scoring.support_ratio(p, r), 6).alias("answer_support"))


@query("rubric_gate", """
    WITH d AS (SELECT user_id, event_type, round(max(value) / 10, 6) AS score FROM events GROUP BY ALL)
    SELECT user_id, round(avg(score), 6) AS mean_score, min(score) AS min_score,
        round(avg(score), 6) >= 7.5 AND min(score) >= 6 AS passed FROM d GROUP BY user_id""")
def rubric_gate(spark, sf):
    dims = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.round(F.max("value") / 10, 6).alias("score"))
    return evaluation.rubric_gate(dims, "user_id").withColumn("mean_score", F.round("mean_score", 6))


@query("assemble_sections", """
    SELECT item_id, '## Executive Summary' || chr(10) || text || chr(10) || chr(10) || '## Problem Statement' || chr(10) || text
        || chr(10) || chr(10) || '## Proposed Solution' || chr(10) || text || chr(10) || chr(10) || '## Timeline' || chr(10) || text
        AS proposal FROM benchmark""")
def assemble_sections(spark, sf):
    rows = dialogue.sections(table(spark, sf, "benchmark"), SECTIONS)
    return context.assemble_sections(rows, "item_id", "section_order", "section", "text")


@query("running_history", """
    SELECT conv_id, turn, role, count(*) OVER w AS n_messages,
        array_to_string(list(role || ': ' || text) OVER w, chr(10)) AS history
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def running_history(spark, sf):
    rows = dialogue.running_history(table(spark, sf, "conversations"))
    return rows.select("conv_id", "turn", "role", "n_messages", dialogue.transcript().alias("history"))


@query("block_history", """
    WITH p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place FROM conversations)
    SELECT conv_id, turn, role, place + 1 AS n_messages, place // 4 AS block,
        array_to_string(list(role || ': ' || text) OVER w, chr(10)) AS history
    FROM p WINDOW w AS (PARTITION BY conv_id, place // 4 ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", ints="block")
def block_history(spark, sf):
    rows = dialogue.block_history(table(spark, sf, "conversations"), 4)
    return rows.select("conv_id", "turn", "role", "n_messages", "block", dialogue.transcript().alias("history"))


@query("last_message", """
    SELECT conv_id, max(turn) AS turn, arg_max(role, turn) AS role, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id""")
def last_message(spark, sf):
    return dialogue.last_message(table(spark, sf, "conversations"))


@query("select_final_draft", """
    WITH d AS (SELECT conv_id AS req_id, turn + 1 AS iteration, text AS draft, length(text) % 12 AS s FROM conversations),
    t AS (SELECT *, s IN (8, 9, 10) AS passed FROM d WHERE iteration <= 3),
    c AS (SELECT req_id, coalesce(min(iteration) FILTER (WHERE passed), max(iteration)) AS iteration FROM t GROUP BY req_id)
    SELECT req_id, iteration, md5(draft) AS draft_md5, passed FROM t JOIN c USING (req_id, iteration)""")
def select_final_draft(spark, sf):
    drafts = table(spark, sf, "conversations").select(
        F.col("conv_id").alias("req_id"), (F.col("turn") + 1).alias("iteration"), F.col("text").alias("draft"),
        F.concat(F.lit("Clear enough.\nFINAL_SCORE: "), F.length("text") % 12).alias("evaluation"))
    return evaluation.final_draft(drafts).select("req_id", "iteration", F.md5("draft").alias("draft_md5"), "passed")


@query("batch_rows", """
    WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5(doc_id || ':42'), doc_id) - 1 AS r FROM documents)
    SELECT doc_id, r // 2 AS batch, r % 2 AS slot FROM r""")
def batch_rows(spark, sf):
    return numbering.batches(table(spark, sf, "documents").select("doc_id"), 2, "doc_id", "42")


@query("capped_scan", "SELECT doc_id, source, n_chars FROM documents ORDER BY doc_id LIMIT 50")
def capped_scan(spark, sf):
    return numbering.limit_sorted(table(spark, sf, "documents").select("doc_id", "source", "n_chars"), ["doc_id"], 50)


@query("union_runs", """
    SELECT user_id, value, 'base' AS model FROM events WHERE event_type = 'view'
    UNION ALL SELECT user_id, value, 'finetuned' FROM events WHERE event_type = 'click'""")
def union_runs(spark, sf):
    runs = [table(spark, sf, "events").where(F.col("event_type") == kind).select("user_id", "value", F.lit(model).alias("model"))
            for kind, model in (("view", "base"), ("click", "finetuned"))]
    return measure.union_runs(*runs)


@query("distinct_paths", """SELECT DISTINCT regexp_replace(url, '[?#].*$', '') AS path FROM pages ORDER BY path""")
def distinct_paths(spark, sf):
    paths = table(spark, sf, "pages").select(F.regexp_replace("url", "[?#].*$", "").alias("path"))
    return numbering.distinct_sorted(paths, "path")
