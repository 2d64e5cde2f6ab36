"""Latency, size, cost and model-comparison tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import fixed_values as V
from docloom.operators.ensemble import union_hits
from docloom.operators.evaluation import numeric_columns
from docloom.operators.numbering import top_k


# How the rates of a stage are named in ``rates_used``.
RATE_PREFIX = {"chat": "chat", "embeddings": "embed", "vlm": "vlm"}


def size_mb(n_bytes: Column) -> Column:
    return F.round(n_bytes / (1024.0 * 1024.0), 2)


def duration(start: Column, end: Column, enabled: Column | None = None) -> Column:
    """Seconds to 4 decimals; NULL when the stage was off."""
    spent = F.round(end - start, 4)
    return spent if enabled is None else F.when(enabled, spent)


def estimate_cost(df: DataFrame, rates: Mapping[str, tuple[float | None, float | None]] = V.UNIT_COSTS,
                  stage: str = "stage", tokens_in: str = "input_tokens",
                  tokens_out: str = "output_tokens") -> DataFrame:
    """``cost_usd`` and ``note`` per row. Missing tokens are noted first, then missing rates, then the stage.

    Stages absent from ``rates`` are unknown. The rates are configuration, so they
    become literals and no join is needed.
    """
    s, i, o = F.col(stage), F.col(tokens_in), F.col(tokens_out)
    thousands_in, thousands_out = (F.coalesce(c, F.lit(0)) / 1000.0 for c in (i, o))
    note = F.when(i.isNull() & o.isNull(), F.lit(V.NOTE_NO_TOKENS))
    cost, used = F.when(i.isNull() & o.isNull(), F.lit(None).cast("double")), None
    for name, (rate_in, rate_out) in rates.items():
        two_sided = name != "embeddings"
        if rate_in is None or (two_sided and rate_out is None):
            note = note.when(s == name, F.lit(V.NOTE_NO_RATE[name]))
            cost = cost.when(s == name, F.lit(None).cast("double"))
            continue
        total = thousands_in * rate_in
        note = note.when(s == name, F.lit(None).cast("string"))
        cost = cost.when(s == name, total + thousands_out * rate_out if two_sided else total)
        listed = {"input": rate_in, "output": rate_out} if two_sided else {"input": rate_in}
        named = F.create_map(*[F.lit(x) for side, rate in listed.items()
                               for x in (f"{RATE_PREFIX[name]}_cost_per_1k_{side}", rate)])
        used = F.when(s == name, named) if used is None else used.when(s == name, named)
    unknown = F.concat(F.lit("Unknown stage '"), s, F.lit("'."))
    nothing = F.lit(None).cast("map<string,double>")
    return df.withColumn("cost_usd", cost).withColumn("note", note.otherwise(unknown)).withColumn(
        "rates_used", nothing if used is None else F.when(F.col("cost_usd").isNotNull(), used))


def improvement(base: Column, variant: Column) -> Column:
    """Gain of the variant over the base in percent, one decimal."""
    return F.round((base - variant) / F.nullif(base, F.lit(0.0)) * 100, 1)


def pair(df: DataFrame, key: Sequence[str], model: str, value: str, base: str, variant: str) -> DataFrame:
    """Mean value of base and variant side by side; one pass, no self-join."""
    return df.where(F.col(model).isin(base, variant)).groupBy(*key).agg(
        F.avg(F.when(F.col(model) == base, F.col(value))).alias("base"),
        F.avg(F.when(F.col(model) == variant, F.col(value))).alias("variant"),
    )


def model_questions(questions: DataFrame, models: Sequence[str]) -> DataFrame:
    """Every model for every question; the short model list is a literal, so rows never shuffle."""
    return questions.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))


def union_runs(a: DataFrame, b: DataFrame) -> DataFrame:
    return union_hits(a, b)


def summary_by(df: DataFrame, key: str) -> DataFrame:
    """Mean of every numeric column per key."""
    return df.groupBy(key).agg(*[F.avg(c).alias(c) for c in numeric_columns(df) if c != key])


def latency(df: DataFrame, model: str, order: str, value: str, warmup: int = 1) -> DataFrame:
    """Mean per model without its first ``warmup`` runs; of runs with one order value any may count as warm.

    Totals are summed where the rows lie, and those of the warm-up rows (a bounded top-k) taken
    off again: no row of a hot model is shuffled. Only models with further runs are listed.
    """
    def totals(rows: DataFrame, suffix: str) -> DataFrame:
        return rows.groupBy(model).agg(F.sum(value).alias(f"_sum{suffix}"), F.count(value).alias(f"_n{suffix}"),
                                       F.count(F.lit(1)).alias(f"_runs{suffix}"))

    warm = totals(top_k(df.select(model, order, value), [model], [order, value], warmup), "_warm")
    warm = warm.withColumnRenamed(model, "_model")
    both = totals(df, "").join(warm, F.col(model).eqNullSafe(F.col("_model")), "left")
    left = [F.col(c) - F.coalesce(F.col(f"{c}_warm"), F.lit(0)) for c in ("_sum", "_n", "_runs")]
    return both.select(model, (left[0] / F.nullif(left[1], F.lit(0))).alias("avg_latency"), left[2].alias("runs")).where("runs > 0")


def conditional_totals(df: DataFrame, n: Column, flag: Column) -> DataFrame:
    """Total, flagged total and the flagged share in percent (2 decimals)."""
    total, part = F.sum(n), F.sum(F.when(flag, n).otherwise(0))
    return df.agg(total.alias("total"), part.alias("trainable"),
                  F.round(100.0 * part / F.nullif(total, F.lit(0)), 2).alias("percent"))


def doc_counts(df: DataFrame, doc: str, kind: str, kinds: Sequence[str]) -> DataFrame:
    """Blocks, tables and images per document, 0 when there are none; whatever is of no listed kind is ``n_other``."""
    other = F.count(F.when(~F.col(kind).isin(*kinds) | F.col(kind).isNull(), 1)).alias("n_other")
    return df.groupBy(doc).agg(*[F.count(F.when(F.col(kind) == k, 1)).alias(f"n_{k}") for k in kinds], other)


def ingest_totals(chunks: DataFrame, table: Sequence[str], cap: int | None = None) -> DataFrame:
    """Tables and chunks indexed, in table order up to an optional cap on tables."""
    per_table = chunks.groupBy(*table).agg(F.count(F.lit(1)).alias("_n"))
    if cap is not None:
        per_table = per_table.orderBy(*table).limit(cap)
    return per_table.agg(F.count(F.lit(1)).alias("tables_indexed"),
                         F.coalesce(F.sum("_n"), F.lit(0)).alias("chunks_indexed"))


def trace_counts(hits: DataFrame, query: str = "query_id", repeat: str = "repeat") -> DataFrame:
    """retrieved, removed and final counts per query."""
    gone = F.sum(F.col(repeat).cast("long"))
    return hits.groupBy(query).agg(F.count(F.lit(1)).alias("retrieved_raw"), gone.alias("dedupe_removed")).withColumn(
        "final_context", F.col("retrieved_raw") - F.col("dedupe_removed"))
