"""The evaluation batch: all golden questions answered and scored as one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom import fixed_values as V
from docloom.functions import scoring
from docloom.operators import context
from docloom.plans.retrieval import retrieve


def evaluate(golden: DataFrame, chunks: DataFrame, k: int = V.TOP_K, completer=None) -> DataFrame:
    """``golden(query_id, question, ground_truth)`` to one scored row per question."""
    hits = retrieve(golden.select("query_id", "question"), chunks, k)
    rows = golden.join(context.pack_contexts(hits, style="source"), "query_id").withColumn(
        "prompt", context.rag_prompt("question_first", F.col("question"), F.col("context")))
    answered = context.answer(rows, completer=completer)
    return answered.select(
        "query_id", "question", "ground_truth", "prediction",
        scoring.rouge_l(F.col("prediction"), F.col("ground_truth")).alias("rougeL_f1"),
        "sources", "contexts_joined",
    )


def scored_and_judged(results: DataFrame) -> DataFrame:
    """The results with lexical support ratios, under names of their own."""
    ctx = F.col("contexts_joined")
    return results.withColumn("reference_support", scoring.support_ratio(F.col("ground_truth"), ctx)).withColumn(
        "answer_support", scoring.support_ratio(F.col("prediction"), ctx))
