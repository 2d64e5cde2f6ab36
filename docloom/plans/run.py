"""A run: questions answered stage by stage, each stage stored and timed, and all that it leaves behind."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom import fixed_values as V
from docloom.operators import context, ensemble, measure
from docloom.plans import retrieval
from docloom.session import written
from docloom.sinks import writers


def run_questions(questions: DataFrame, collection: DataFrame, base: str, run_id: str, scorer=ensemble.lexical_overlap,
                  use_reranker: bool = True, completer=None) -> str:
    """Answer ``questions(query_id, question)`` from a stored collection; all artifacts of the run in one write.

    Every question leaves its raw hits (as table and as text), the repeats removed, the final context, the prompt, the answer
    and a trace. Timings are the seconds that a stage took for all questions together, since they go through it
    together. A question without a hit leaves nothing. Returns the run's folder.
    """
    took: dict[str, float] = {}
    began = time.perf_counter()

    def stage(name: str, df: DataFrame) -> DataFrame:
        start = time.perf_counter()
        out = written(df, f"run-{name}")
        took[name] = time.perf_counter() - start
        return out

    hits = stage("retrieval", retrieval.ensemble_hits(questions, collection))
    kept = stage("dedupe", hits.where(~F.col("repeat")))
    asked = ensemble.pairs(questions, kept)
    if use_reranker:
        final = stage("rerank", ensemble.rerank(asked, V.FINAL_CONTEXT_K, scorer=scorer))
    else:
        final = asked.withColumn("rerank_score", F.lit(None).cast("double")).withColumn("final_rank", F.col("ensemble_rank"))
    contexts = context.build_context(final, "index", ["query_id", "question"], "final_rank")
    prompted = stage("context_build", contexts.withColumn("prompt", context.rag_prompt("cited", F.col("question"), F.col("context"))))
    answers = stage("llm", context.answer(prompted, completer=completer))
    took["total"] = time.perf_counter() - began

    out = f"{base}/run_{run_id}"
    config = {"TOP_K_PER_MODALITY": V.TOP_K_PER_MODALITY, "FINAL_CONTEXT_K": V.FINAL_CONTEXT_K, "ENABLE_DEDUPE": True,
              "ENABLE_RERANK": use_reranker, "RERANK_TOP_K": V.FINAL_CONTEXT_K if use_reranker else None}
    counts = measure.trace_counts(hits).join(questions.select("query_id", "question"), "query_id")
    timed = questions.select("query_id", *[F.lit(s).alias(name) for name, s in took.items()])
    paths = {name.replace(".", "_"): f"{out}/q_idx=q_{{query}}/artifact={name}" for name in writers.ARTIFACTS}
    traces = writers.trace_frame(counts, config, timings=timed, artifacts=paths)
    return writers.write_artifacts(writers.artifact_rows(hits, answers, traces), out)
