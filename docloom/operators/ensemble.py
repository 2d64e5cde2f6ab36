"""Merging, deduplicating and reranking hits of several collections."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from docloom import fixed_values as V
from docloom.functions import text as tx
from docloom.operators.numbering import top_k


def union_hits(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, duplicates kept, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def tag(df: DataFrame, modality: str, score: str = "score") -> DataFrame:
    return df.withColumn("modality", F.lit(modality)).withColumn(
        "retrieval_score", F.col(score).cast("double"))


def modality_rank(c: Column) -> Column:
    listed = F.array_position(F.array(*[F.lit(m) for m in V.MODALITY_ORDER]), c).cast("int")
    return F.when(listed > 0, listed).otherwise(len(V.MODALITY_ORDER) + 1)


def ensemble(hits: DataFrame, k: int = V.FINAL_CONTEXT_K, query: str = "query_id",
             rank: str = "rank", score: str = "score") -> DataFrame:
    """Merge per-modality hits by score; a missing score sorts last, ties keep modality order."""
    order = [F.coalesce(F.col(score), F.lit(V.MISSING_SCORE)), modality_rank(F.col("modality")), F.col(rank)]
    return top_k(hits, [query], order, k, "ensemble_rank")


def chunk_ref() -> Column:
    return tx.first_filled(F.col("chunk_uid"), F.col("vector_id"), F.col("id"), default="N/A")


def source_hint() -> Column:
    return tx.first_filled(F.col("source_docx"), F.col("source_csv"), F.col("source_image"),
                           F.col("source_file"), default="N/A")


def fingerprint(content: str = "content") -> Column:
    """Own ids first, then document and anchor, then a hash of the normalised text."""
    own = [F.when(tx.filled(F.col(k)).isNotNull(), F.concat(F.lit(f"{k}::"), F.col(k)))
           for k in ("chunk_uid", "vector_id", "id")]
    anchor = tx.first_filled(F.col("table_id"), F.col("figure_id"), F.col("source_csv"), F.col("source_image"))
    placed = F.concat(F.lit("anchor::"), tx.filled(F.col("doc_id")), F.lit("::"), anchor)
    return F.coalesce(*own, placed, text_fingerprint(content))


def text_fingerprint(content: str = "content") -> Column:
    hashed = F.substring(F.sha2(tx.normalize(F.col(content)), 256), 1, 16)
    return F.concat(F.lit("texthash::"), hashed)


def lexical_overlap(query: Column, content: Column) -> Column:
    """Share of the distinct query tokens found in the content; the default pair scorer."""
    asked = F.array_distinct(tx.tokens(query))
    found = F.array_intersect(asked, tx.tokens(content))
    return F.coalesce(F.size(found) / F.nullif(F.size(asked), F.lit(0)), F.lit(0.0))


def pair_scorer(score: Callable[[list[str], list[str]], list[float]]) -> Callable[[Column, Column], Column]:
    """Wrap a user function over (queries, contents) batches as a pair scorer."""

    @pandas_udf(T.DoubleType())
    def apply(queries: pd.Series, contents: pd.Series) -> pd.Series:
        return pd.Series(score(queries.fillna("").tolist(), contents.fillna("").tolist()), dtype="float64")

    return apply


def pairs(queries: DataFrame, hits: DataFrame, query_id: str = "query_id") -> DataFrame:
    """(query text, content) for each hit."""
    return hits.join(queries, query_id)


def rerank(hits: DataFrame, k: int, query: str = "query_id", question: str = "question",
           content: str = "content", prior: str = "ensemble_rank",
           scorer: Callable[[Column, Column], Column] = lexical_overlap) -> DataFrame:
    """Score each pair, best first, ties by the prior rank."""
    scored = hits.withColumn("rerank_score", scorer(F.col(question), F.col(content)).cast("double"))
    return top_k(scored, [query], [F.desc("rerank_score"), F.col(prior)], k, "final_rank")


def cut(hits: DataFrame, use_reranker: bool, rank: str = "rank") -> DataFrame:
    """The candidates to fetch: more when a reranker follows."""
    return hits.where(F.col(rank) <= (V.INITIAL_K if use_reranker else V.TOP_K))


def dedupe_small_lists(hits: DataFrame, query: str, fp: str, rank: str) -> DataFrame:
    """Mark repeats inside each query's short hit list (bounded by the cut before it)."""
    w = Window.partitionBy(query, fp).orderBy(rank)
    return hits.withColumn("repeat", F.row_number().over(w) > 1)
