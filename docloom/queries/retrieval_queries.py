"""Nearest neighbours, ensembles, deduplication, contexts and answers."""

import numpy as np
from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.operators import context, embed, ensemble, numbering, search
from docloom.plans import evaluation as eval_plan
from docloom.plans import retrieval
from docloom.queries import frames
from docloom.queries import sqltext as q
from docloom.queries.registry import query, table, wide

CENT_SCORED = q.CENTROIDS + f""",
    s AS (SELECT query_id, vec_id, label, {q.d2('embedding', 'q')} AS score FROM cent, embeddings)"""


@query("knn_l2", "WITH" + CENT_SCORED + """
    SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank
    FROM s QUALIFY rank <= 3""", ints="rank")
def knn_l2(spark, sf):
    return search.knn(frames.centroids(spark, sf), table(spark, sf, "embeddings"), 3)


@query("knn_collection", "WITH" + CENT_SCORED + """
    SELECT query_id, label AS collection, vec_id, score,
        row_number() OVER (PARTITION BY query_id, label ORDER BY score, vec_id) AS rank FROM s QUALIFY rank <= 4""", ints="rank")
def knn_collection(spark, sf):
    vectors = table(spark, sf, "embeddings").withColumnRenamed("label", "collection")
    return search.knn(frames.centroids(spark, sf), vectors, 4, group="collection")


@query("knn_lsh", "WITH" + CENT_SCORED + """
    SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank
    FROM s QUALIFY rank <= 3""", ints="rank")
def knn_lsh(spark, sf):
    return search.knn_indexed(frames.centroids(spark, sf), search.build_index(table(spark, sf, "embeddings")), 3)


@query("query_candidate_pairs", "WITH" + q.HITS + """
    SELECT query_id, rank, 'Which text of label ' || query_id || ' fits best?' AS question, md5(content) AS content_md5 FROM hits""", ints="rank")
def query_candidate_pairs(spark, sf):
    asked = frames.centroids(spark, sf).select(
        "query_id", F.concat(F.lit("Which text of label "), "query_id", F.lit(" fits best?")).alias("question"))
    return ensemble.pairs(asked, frames.hits(spark, sf)).select(
        "query_id", "rank", "question", F.md5("content").alias("content_md5"))


@query("retrieval_rank", "WITH" + q.HITS + f"""
    SELECT query_id, rank, source, score AS faiss_distance, {q.preview('content')} AS preview FROM hits""", ints="rank")
def retrieval_rank(spark, sf):
    return frames.hits(spark, sf).select(
        "query_id", "rank", "source", F.col("score").alias("faiss_distance"), tx.preview(F.col("content")).alias("preview"))


@query("candidate_cut", "WITH" + CENT_SCORED + """,
    r AS (SELECT query_id, vec_id, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM s)
    SELECT query_id, vec_id, rank, 'rerank' AS mode FROM r WHERE rank <= 10
    UNION ALL SELECT query_id, vec_id, rank, 'plain' FROM r WHERE rank <= 3""", ints="rank")
def candidate_cut(spark, sf):
    found = search.knn(frames.centroids(spark, sf), table(spark, sf, "embeddings"), 10)
    both = [ensemble.cut(found, flag).withColumn("mode", F.lit(mode)) for flag, mode in ((True, "rerank"), (False, "plain"))]
    return ensemble.union_hits(*both).select("query_id", "vec_id", "rank", "mode")


@query("global_chunk_index", "WITH" + q.windows(500, 50) + """
    SELECT doc_id, chunk_index, row_number() OVER (ORDER BY doc_id, chunk_index) AS chunk_index_global FROM chunks""", ints="chunk_index")
def global_chunk_index(spark, sf):
    chunks = frames.fixed_chunks(spark, sf).select("doc_id", "chunk_index")
    return numbering.with_global_index(chunks)


FP = "WITH" + q.METADATA + f""",
    fp AS (SELECT row_id, coalesce('chunk_uid::' || nullif(chunk_uid, ''), 'vector_id::' || nullif(vector_id, ''),
        'id::' || nullif(id, ''),
        'anchor::' || nullif(doc_id, '') || '::' || coalesce(nullif(table_id, ''), nullif(figure_id, ''), nullif(source_csv, ''), nullif(source_image, '')),
        'texthash::' || substr(sha256({q.normalized('content')}), 1, 16)) AS fingerprint FROM meta)"""
TEXT_FP = f"""
    WITH fp AS (SELECT doc_id, source, 'texthash::' || substr(sha256({q.normalized('text')}), 1, 16) AS fingerprint FROM documents),
    n AS (SELECT *, row_number() OVER (PARTITION BY fingerprint ORDER BY doc_id) AS rn FROM fp)"""


@query("fingerprint", FP + "SELECT row_id, fingerprint FROM fp")
def fingerprint(spark, sf):
    return frames.metadata(spark, sf).select("row_id", ensemble.fingerprint().alias("fingerprint"))


def _text_prints(spark, sf):
    return wide(spark, sf, "documents", "doc_id", "source", "text").select("doc_id", "source", ensemble.text_fingerprint("text").alias("fingerprint"))


@query("dedupe_keep_first", TEXT_FP + "SELECT doc_id, source, fingerprint FROM n WHERE rn = 1")
def dedupe_keep_first(spark, sf):
    return numbering.keep_first(_text_prints(spark, sf), ["fingerprint"], "doc_id")


@query("dedupe_removed", TEXT_FP + "SELECT doc_id, source, fingerprint FROM n WHERE rn > 1")
def dedupe_removed(spark, sf):
    return numbering.removed_rows(_text_prints(spark, sf), ["fingerprint"], "doc_id")


@query("ensemble_topk", "WITH" + q.ENSEMBLE + "SELECT query_id, chunk_id, modality, score AS retrieval_score, ensemble_rank FROM ens", ints="ensemble_rank")
def ensemble_topk(spark, sf):
    return frames.ensemble_hits(spark, sf).select("query_id", "chunk_id", "modality", "retrieval_score", "ensemble_rank")


@query("rerank_topk", "WITH" + q.ENSEMBLE + """
    SELECT query_id, chunk_id, ensemble_rank, round(rerank_score, 6) AS rerank_score, final_rank FROM reranked""", ints="ensemble_rank final_rank")
def rerank_topk(spark, sf):
    kept = frames.ensemble_hits(spark, sf).where(~F.col("repeat"))
    final = ensemble.rerank(ensemble.pairs(frames.questions(spark, sf), kept), 7)
    return final.select("query_id", "chunk_id", "ensemble_rank", F.round("rerank_score", 6).alias("rerank_score"), "final_rank")


@query("context_concat", "WITH" + q.HITS + """,
    c AS (SELECT * FROM hits WHERE rank <= 3)
    SELECT query_id, string_agg('[Context ' || rank || ']' || chr(10) || content, chr(10) || chr(10) ORDER BY rank) AS numbered,
        string_agg('[Source: ' || source || ']' || chr(10) || content, chr(10) || chr(10) ORDER BY rank) AS by_source,
        string_agg('[' || rank || '] chunk_id=' || vec_id || ' | modality=text | doc_id=' || vec_id || ' | source=' || source
            || '.docx | score=' || score || ' | rerank=None' || chr(10) || content, chr(10) || chr(10) ORDER BY rank) AS by_index
    FROM c GROUP BY query_id""")
def context_concat(spark, sf):
    hits = retrieval.with_metadata(frames.hits(spark, sf, 3).select(
        "*", F.col("vec_id").cast("string").alias("vector_id"), F.col("vec_id").cast("string").alias("doc_id"),
        F.concat("source", F.lit(".docx")).alias("source_docx"), F.lit("text").alias("modality"),
        F.col("score").alias("retrieval_score"), F.lit(None).cast("double").alias("rerank_score")))
    styles = {"numbered": "numbered", "by_source": "source", "by_index": "index"}
    blocks = [context.joined_in_order("rank", F.concat(context.block_header(s, "rank"), F.lit("\n"), "content"), "\n\n").alias(n)
              for n, s in styles.items()]
    return hits.groupBy("query_id").agg(*blocks)


@query("join_split_contexts", "WITH" + q.HITS + """
    SELECT query_id, string_agg(source, ' | ' ORDER BY rank) AS sources, count(*) AS n_contexts,
        string_agg(md5(content), ',' ORDER BY rank) AS context_md5s FROM hits WHERE rank <= 3 GROUP BY query_id""")
def join_split_contexts(spark, sf):
    packed = context.unpack_contexts(context.pack_contexts(frames.hits(spark, sf, 3)))
    return packed.select("query_id", "sources", F.size("contexts").cast("long").alias("n_contexts"),
                         F.array_join(F.transform("contexts", F.md5), ",").alias("context_md5s"))


@query("distinct_sources", "WITH" + q.HITS + """
    SELECT query_id, string_agg(source, ' | ' ORDER BY r) AS sources, count(*) AS n_sources
    FROM (SELECT query_id, source, min(rank) AS r FROM hits GROUP BY ALL) GROUP BY query_id""")
def distinct_sources(spark, sf):
    return context.sources_used(frames.hits(spark, sf))


@query("union_modalities", "WITH" + q.COLLECTION + """
    SELECT modality, count(*) AS n_rows, count(DISTINCT chunk_id) AS n_ids, sum(length(content))::BIGINT AS n_chars
    FROM coll GROUP BY modality""")
def union_modalities(spark, sf):
    return frames.collection(spark, sf).groupBy("modality").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("chunk_id").alias("n_ids"),
        F.sum(F.length("content")).alias("n_chars"))


@query("embed_hashed", "WITH" + q.vectors("e", "documents", "doc_id", "text") + """
    SELECT doc_id, round(list_sum(list_transform(v, lambda x: x::DOUBLE)), 6) AS total,
        md5(array_to_string(list_transform(v, lambda x: round(x::DOUBLE * 1000000)::BIGINT), ',')) AS vector_md5 FROM e""")
def embed_hashed(spark, sf):
    vec = embed.embed(wide(spark, sf, "documents", "doc_id", "text"), "text")
    micro = F.transform("embedding", lambda x: F.round(x.cast("double") * 1000000).cast("bigint").cast("string"))
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return vec.select("doc_id", F.round(total, 6).alias("total"), F.md5(F.array_join(micro, ",")).alias("vector_md5"))


def character_vectors(texts):
    """A stand-in for a user model: shares of 32 character classes."""
    out = np.zeros((len(texts), 32), dtype=np.float32)
    for i, t in enumerate(texts):
        codes = np.frombuffer(t.encode("utf-8"), dtype=np.uint8) % 32
        out[i] = np.bincount(codes, minlength=32) / max(1, len(codes))
    return out


@query("embed_udf", """
    SELECT doc_id, 32 AS dim, CASE WHEN text = '' THEN 0 ELSE 1 END::DOUBLE AS total FROM documents""")
def embed_udf(spark, sf):
    vec = embed.embed(wide(spark, sf, "documents", "doc_id", "text"), "text", embedder=character_vectors)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return vec.select("doc_id", F.size("embedding").alias("dim"), F.round(total, 4).alias("total"))


ANSWER = """
    WITH asked AS (SELECT i.item_id, i.text AS question, d.text AS context FROM benchmark i JOIN documents d ON d.doc_id = i.item_id),
    """ + q.best_sentence("asked", "item_id") + """
    SELECT item_id, prediction FROM best"""


@query("answer_extractive", ANSWER)
def answer_extractive(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("item_id"), F.col("text").alias("context"))
    asked = table(spark, sf, "benchmark").select("item_id", F.col("text").alias("question"))
    return context.answer(asked.join(docs, "item_id")).select("item_id", "prediction")


def shared_letters(queries, contents):
    """A stand-in for a user pair model."""
    return [len(set(a) & set(b)) / max(1, len(set(a))) for a, b in zip(queries, contents)]


@query("rerank_scorer_slot", "WITH" + q.HITS + """,
    c AS (SELECT *, list_distinct(string_split(lang, '')) AS a, list_distinct(string_split(content, '')) AS b FROM hits),
    s AS (SELECT query_id, vec_id, rank, len(list_intersect(a, b)) / len(a)::DOUBLE AS rerank_score FROM c)
    SELECT query_id, vec_id, rerank_score, row_number() OVER (PARTITION BY query_id ORDER BY rerank_score DESC, rank) AS final_rank
    FROM s QUALIFY final_rank <= 3""", ints="final_rank")
def rerank_scorer_slot(spark, sf):
    hits = frames.hits(spark, sf).withColumn("question", F.col("lang"))
    return ensemble.rerank(hits, 3, prior="rank", scorer=ensemble.pair_scorer(shared_letters)).select(
        "query_id", "vec_id", "rerank_score", "final_rank")


QA = "WITH" + q.windows(500, 50) + ",\n    ck AS (SELECT *, doc_id || ':' || chunk_index AS chunk_id FROM chunks)," + q.vectors(
    "cv", "ck", "chunk_id", "content") + "," + q.vectors("qv", "benchmark", "item_id", "text") + f""",
    sc AS (SELECT item_id AS query_id, chunk_id, {q.d2('cv.v', 'qv.v')} AS score FROM qv, cv),
    top AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, chunk_id) AS rank FROM sc QUALIFY rank <= 3)"""


@query("answer_questions", QA + f"""
    SELECT t.query_id, b.text AS question, string_agg('[Source: ' || c.source || ']' || chr(10) || c.content,
        chr(10) || chr(10) ORDER BY rank) AS context
    FROM top t JOIN ck c USING (chunk_id) JOIN benchmark b ON b.item_id = t.query_id GROUP BY t.query_id, b.text""")
def answer_questions(spark, sf):
    return retrieval.answer_questions(frames.questions(spark, sf), frames.fixed_chunks(spark, sf)).select(
        "query_id", "question", "context")


EVALUATED = "WITH RECURSIVE" + QA.removeprefix("WITH") + """,
    asked AS (SELECT t.query_id, b.text AS question, string_agg('[Source: ' || c.source || ']' || chr(10) || c.content,
        chr(10) || chr(10) ORDER BY rank) AS context, string_agg(c.source, ' | ' ORDER BY rank) AS sources,
        string_agg(c.content, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS contexts_joined
      FROM top t JOIN ck c USING (chunk_id) JOIN benchmark b ON b.item_id = t.query_id GROUP BY t.query_id, b.text),
    """ + q.best_sentence("asked", "query_id") + f""",
    pr AS (SELECT query_id, {q.words('prediction')} AS p, {q.words('question')} AS r, {q.words('contexts_joined')} AS c
      FROM best JOIN asked USING (query_id)),
    """ + q.lcs("pr", "query_id") + """
    SELECT query_id, prediction, rouge AS rougeL_f1, sources,
        round(coalesce(len(list_intersect(list_distinct(r), c)) / nullif(len(list_distinct(r)), 0), 0), 6) AS reference_support,
        round(coalesce(len(list_intersect(list_distinct(p), c)) / nullif(len(list_distinct(p)), 0), 0), 6) AS answer_support
    FROM asked JOIN best USING (query_id) JOIN pr USING (query_id) JOIN scored USING (query_id)"""


@query("evaluate_questions", EVALUATED)
def evaluate_questions(spark, sf):
    golden = frames.questions(spark, sf).withColumn("ground_truth", F.col("question"))
    results = eval_plan.evaluate(golden, frames.fixed_chunks(spark, sf))
    return eval_plan.scored_and_judged(results).select(
        "query_id", "prediction", F.round("rougeL_f1", 6).alias("rougeL_f1"), "sources",
        F.round("reference_support", 6).alias("reference_support"), F.round("answer_support", 6).alias("answer_support"))
