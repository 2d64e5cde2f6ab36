"""Evaluation tables: joins of predictions and metrics, summaries, gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom import fixed_values as V

QUARTILES = (0.25, 0.5, 0.75)
BRACKET = 1e-4
#: Rows of a bracket up to which they are counted in one task.
BAND_ROWS = 1_000_000


def attach_predictions(golden: DataFrame, predictions: DataFrame, key: str = "idx") -> DataFrame:
    return golden.join(predictions, key)


def merge_metrics(results: DataFrame, judged: DataFrame, key: str = "idx") -> DataFrame:
    return results.join(judged, key, "left")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def numeric_means(df: DataFrame) -> DataFrame:
    """Mean of every numeric column; others are left out."""
    return df.agg(*[F.avg(c).alias(c) for c in numeric_columns(df)])


def _brackets(values: DataFrame, qs: Sequence[float]) -> list[tuple[float, float, float, float]]:
    """(q, low, high, spot): values between which each quantile lies, and its place among all values.

    Sketch quantiles a little to both sides bracket an answer. As long as one bracket holds more than
    ``BAND_ROWS`` rows, a sketch of these alone brackets it again. A few numbers per quantile reach the driver.
    """
    def sketched(rows: DataFrame, marks: Sequence[float]) -> list[float]:
        listed = F.array(*[F.lit(float(m)) for m in marks])
        return rows.agg(F.percentile_approx("v", listed, F.lit(int(4 / BRACKET)))).first()[0]

    def around(share: float) -> tuple[float, float]:
        return max(0.0, share - BRACKET), min(1.0, share + BRACKET)

    n, lo, hi = values.agg(F.count(F.lit(1)), F.min("v"), F.max("v")).first()
    if not n:
        return []
    found = sketched(values, [m for q in qs for m in around(q)])
    out = []
    for i, q in enumerate(qs):
        low = lo if q <= BRACKET else found[2 * i]
        high = hi if q >= 1 - BRACKET else found[2 * i + 1]
        out.append((float(q), low, high, q * (n - 1)))
    while True:
        counts = values.agg(*[F.count(F.when(F.col("v") < low, 1)) for _, low, _, _ in out],
                            *[F.count(F.when(F.col("v").between(low, high), 1)) for _, low, high, _ in out]).first() if n > BAND_ROWS else ()
        narrower = False
        for i, (q, low, high, spot) in enumerate(out):
            below, inside = (counts[i], counts[len(out) + i]) if counts else (0, 0)
            if inside > BAND_ROWS and low < high:
                band = values.where(F.col("v").between(low, high))
                start, end = sketched(band, around((spot - below) / inside))
                # A bracket must keep the value before and after the spot, so its ends stay where the sketch found values.
                if (start, end) != (low, high):
                    out[i], narrower = (q, start, end, spot), True
        if not narrower:
            return out


def exact_quantiles(df: DataFrame, col: str, qs: Sequence[float] = QUARTILES) -> DataFrame:
    """Rows ``(q, value)``: linearly interpolated quantiles, exact at any size.

    Each answer is bracketed by sketches; values are counted per distinct value, and only
    those inside a bracket meet in its running count. A value shared by a third of all rows is a single row there.
    NaN counts as missing; without values there are no rows.
    """
    values = df.select(F.col(col).cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    found = _brackets(values, qs)
    if not found:
        return df.sparkSession.createDataFrame([], "q double, value double")
    limits = F.array(*[F.struct(*[F.lit(x).cast("double").alias(name) for name, x in zip(("q", "low", "high", "spot"), bracket)])
                       for bracket in found])
    counted = values.groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    # Outside a bracket only the count and the value next to it matter: one row per side.
    side = F.when(F.col("v") < F.col("k.low"), -1).when(F.col("v") > F.col("k.high"), 1).otherwise(0)
    tagged = counted.select("v", "c", F.explode(limits).alias("k")).withColumn("side", side)
    folded = tagged.groupBy("k", "side", F.when(F.col("side") == 0, F.col("v")).alias("own")).agg(
        F.sum("c").alias("c"),
        F.when(F.col("side") < 0, F.max("v")).otherwise(F.min("v")).alias("v"))
    upto = F.sum("c").over(Window.partitionBy("k").orderBy("v"))
    spot = F.col("k.spot")
    placed = folded.select("k", "v", upto.alias("upto"))
    lower = F.min(F.when(F.col("upto") > F.floor(spot), F.col("v")))
    upper = F.min(F.when(F.col("upto") > F.ceil(spot), F.col("v")))
    return placed.groupBy("k").agg(lower.alias("a"), upper.alias("z")).select(
        F.col("k.q").alias("q"), (F.col("a") + (F.col("z") - F.col("a")) * (spot - F.floor(spot))).alias("value"))


def describe(df: DataFrame, col: str) -> DataFrame:
    """count, mean, sample deviation, min, quartiles and max of one column, as one row; NaN counts as missing."""
    df = df.where(~F.isnan(F.col(col).cast("double")))
    base = df.agg(
        F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
        F.min(col).alias("min"), F.max(col).alias("max"),
    )
    found = exact_quantiles(df, col).agg(*[
        F.max(F.when(F.col("q") == q, F.col("value"))).alias(f"p{int(q * 100)}") for q in QUARTILES])
    quartiles = found.select(F.struct(*found.columns)).scalar()
    return base.select("*", quartiles.alias("_q")).select(*base.columns, "_q.*")


def grounding_hits(hits: DataFrame, golden: DataFrame, query: str = "query_id") -> DataFrame:
    """Per question: how many retrieved sources begin with the cited document id."""
    cited = F.trim(F.element_at(F.split(F.col("grounding_reference"), r"\|"), 1))
    joined = hits.join(golden.select(query, cited.alias("cited")), query)
    return joined.withColumn("relevant", F.startswith(F.col("source"), F.col("cited")).cast("int"))


def context_precision(ranked: DataFrame, query: str = "query_id", rank: str = "rank",
                      relevant: str = "relevant") -> DataFrame:
    """Mean precision at the ranks of relevant hits (0 without any); lists are cut to k before."""
    w = Window.partitionBy(query).orderBy(rank)
    at_rank = ranked.withColumn("_p", F.avg(relevant).over(w))
    share = F.sum(F.col("_p") * F.col(relevant)) / F.nullif(F.sum(relevant), F.lit(0))
    return at_rank.groupBy(query).agg(F.coalesce(share, F.lit(0.0)).alias("context_precision"))


def rubric_gate(scores: DataFrame, key: str, score: str = "score") -> DataFrame:
    """Pass when the mean over the dimensions and the weakest dimension both reach their bars."""
    return scores.groupBy(key).agg(F.avg(score).alias("mean_score"), F.min(score).alias("min_score")).withColumn(
        "passed", (F.col("mean_score") >= V.RUBRIC_MEAN) & (F.col("min_score") >= V.RUBRIC_FLOOR))


def passed_by_text(evaluation: Column) -> Column:
    from docloom.functions.text import contains_any

    return contains_any(evaluation, V.PASS_MARKERS)


def final_draft(drafts: DataFrame, key: str = "req_id", iteration: str = "iteration",
                evaluation: str = "evaluation", max_iter: int = V.MAX_DRAFTS) -> DataFrame:
    """The first passing iteration within the limit, else the last one within it."""
    tried = drafts.where(F.col(iteration) <= max_iter).withColumn("passed", passed_by_text(F.col(evaluation)))
    choice = tried.groupBy(key).agg(
        F.coalesce(F.min(F.when(F.col("passed"), F.col(iteration))), F.max(iteration)).alias(iteration))
    return tried.join(choice, [key, iteration])
