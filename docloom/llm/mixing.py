"""Mixing sources to target weights by capped water-filling.

Sources share a budget of words by weight. A source cannot give more than ``epochs`` times what it
holds: where its share is above that it is clamped, and what is left over is shared by weight among
the others, until no share is above. Each round is one aggregate over one row per source; only three
numbers return to the driver.

A target is met in whole and fractional repetitions. Every document of a source is taken
``target div size`` times. For the rest the documents stand in a seeded order and are taken once
more until the target is reached; the document on which it falls gives only its first words, so a
source's words meet its target to the word. The order is never sorted as a whole: its range is cut into
slices, the slices' sizes are summed, and only the slice on which the target falls is looked at row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import columns_of, joined_small, saved
from docloom.operators.numbering import ranged_positions

#: Rows that a slice of the seeded order should hold, and the most slices; beyond that slices grow.
SLICE_ROWS, MOST_SLICES = 256, 65_536
_DRAWS = 1 << 60
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII blanks; none in a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, budget: float) -> DataFrame:
    """Add ``target`` to rows of (weight, cap): the budget shared by weight, with no share above its cap.

    What caps leave over goes to the others by weight. If all caps together are below the budget, every
    target is its cap; without any weight, 0.
    """
    clamped, count = F.lit(False), 0
    rest, weights = budget, sources.agg(F.sum("weight")).first()[0]
    while weights:
        # The level only rises from round to round, so what was above its cap stays above.
        above = F.col("weight") * F.lit(float(rest)) / F.lit(float(weights)) > F.col("cap")
        now, caps, others = sources.agg(
            F.count(F.when(above, 1)), F.sum(F.when(above, F.col("cap"))), F.sum(F.when(~above, F.col("weight")))).first()
        if now == count:
            break
        clamped, count, rest, weights = above, now, budget - caps, others
    share = F.col("weight") * F.lit(float(rest)) / F.lit(float(weights)) if weights else F.lit(0.0)
    return sources.withColumn("target", F.when(clamped, F.col("cap")).otherwise(share))


def plan(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, epochs: float = 2.0, seed: int = 7,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """How often and how far the mix takes each document.

    Returns doc_id, size (words), source_size, target (words the source should give), taken (words taken of this
    document, repeats counted), source, copies (whole repetitions) and cut (words of one more, shorter repetition).

    The sources, by code point and null last, take the weights in turn; the budget is ``share`` of all words. A null
    text has no words; a null source is a source of its own, apart from the empty one. Null and repeated ids are
    kept; rows that agree in id, size and source are interchangeable. A source without words gives none; an empty
    table gives an empty result. Other columns are ignored. The seed alone decides the draw, so reruns agree.
    """
    given = columns_of(docs, doc_id=id_col, text=text_col, source=source_col)
    draw = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                       F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    rows = saved(given.select(
        "doc_id", "source", F.col("source").isNull().alias("unnamed"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("stratum"),
        word_count(F.col("text")).alias("size"), F.conv(F.substring(F.md5(draw), 1, 15), 16, 10).cast("long").alias("draw"),
    ), "mix-rows")
    key = ["unnamed", "stratum"]
    sizes = saved(rows.groupBy(*key).agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("of")), "mix-sources")
    words, count = sizes.agg(F.sum("source_size"), F.sum("of")).first()
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    weighed = ranged_positions(sizes, [], key, "place").withColumn("weight", turn).withColumn("cap", F.col("source_size") * F.lit(float(epochs)))
    quota = F.floor(F.col("target") + 0.5).cast("long")
    filled = saved(water_fill(weighed, share * (words or 0)).withColumn("quota", quota), "mix-targets").select(
        *key, "source_size", "target",
        F.expr("if(source_size > 0, quota div source_size, 0L)").alias("copies"),
        F.expr("if(source_size > 0, quota % source_size, 0L)").alias("rest"))

    slices = max(1, min(-(-(count or 0) // SLICE_ROWS), MOST_SLICES))
    rows = rows.withColumn("slice", F.expr(f"draw div {-(-_DRAWS // slices)}L"))
    earlier = Window.partitionBy(*key).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy(*key, "slice").agg(F.sum("size").alias("in_slice")).withColumn("before", F.coalesce(F.sum("in_slice").over(earlier), F.lit(0)))
    # The slice on which a source's rest falls: those before it are taken whole, those after it not at all.
    met = parts.join(filled.select(*key, "rest"), key).where("before < rest AND rest <= before + in_slice")
    edge = met.select(*key, F.col("slice").alias("edge"), "before")
    filled = saved(joined_small(filled, edge, key, "left"), "mix-plan")
    planned = joined_small(rows, filled, key)
    inside = Window.partitionBy(*key).orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    far = planned.where("edge IS NULL OR slice <> edge").withColumn("cut", F.expr("if(slice < edge, size, 0L)"))
    near = planned.where("slice = edge").withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    near = near.withColumn("cut", F.expr("greatest(0L, least(size, rest - before))"))
    both = far.withColumn("cut", F.coalesce("cut", F.lit(0))).unionByName(near)
    whole = F.col("size") > 0
    return both.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size") + F.col("cut")).alias("taken"), "source",
        (F.col("copies") + F.when(whole & (F.col("cut") == F.col("size")), 1).otherwise(0)).cast("long").alias("copies"),
        F.when(F.col("cut") < F.col("size"), F.col("cut")).otherwise(0).cast("long").alias("cut"))


def mixture(docs: DataFrame, planned: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The mixed rows: each document as often as planned, a cut one with its first words, with all its columns.

    ``planned`` comes from :func:`plan`. Documents are found by their id, which must name one row; rows with a null id, rows
    that repeat an id, and documents without words give nothing.
    """
    names = docs.columns
    one = planned.groupBy(F.col("doc_id").alias("_id")).agg(F.max("copies").alias("_copies"), F.max("cut").alias("_cut"), F.count(F.lit(1)).alias("_rows"))
    taken = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(f"`{id_col}`").alias("_id")).join(
        one.where("_rows = 1 AND (_copies > 0 OR _cut > 0)"), "_id")
    lengths = F.concat(F.array_repeat(F.lit(-1).cast("long"), F.col("_copies").cast("int")), F.when(F.col("_cut") > 0, F.array("_cut")).otherwise(F.array().cast("array<long>")))
    each = taken.select("row", F.explode(lengths).alias("_words"))
    body = F.col("row").getField(text_col)
    # What splitting leaves over after so many words; blanks at the start make an empty part before the first word.
    parts = F.split(body, r"[\x20\x09-\x0D]+", (F.col("_words") + 1 + F.when(body.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)).cast("int"))
    first = F.rtrim(F.left(body, F.length(body) - F.length(F.element_at(parts, -1))), F.lit(" \t\n\x0b\f\r"))
    return each.select(*[
        F.when(F.col("_words") < 0, body).otherwise(first).alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in names])


#: The plan of the registered query, with the level of the caps read off a sort by cap over weight.
ORACLE = r"""
    WITH docs AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        ('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS draw FROM documents),
    sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
    weighed AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
        2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS budget FROM sources),
    levels AS (SELECT *, weight * (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) > cap AS clamped FROM weighed),
    targets AS (SELECT source, source_size, CASE WHEN clamped THEN cap ELSE weight * (budget - coalesce(sum(cap) FILTER (clamped) OVER (), 0))
        / sum(weight) FILTER (NOT clamped) OVER () END AS target FROM levels),
    quotas AS (SELECT *, floor(target + 0.5)::BIGINT AS quota FROM targets),
    drawn AS (SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY draw, doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM docs),
    met AS (SELECT doc_id, size, drawn.source, source_size, target, CASE WHEN source_size > 0 THEN quota // source_size ELSE 0 END AS whole, CASE WHEN source_size > 0
        THEN greatest(0, least(size, quota % source_size - before)) ELSE 0 END AS part
      FROM drawn JOIN quotas ON drawn.source IS NOT DISTINCT FROM quotas.source)
    SELECT doc_id, size, source_size, target, (whole * size + part)::BIGINT AS taken, source,
        (whole + (size > 0 AND part = size)::INT)::BIGINT AS copies, (CASE WHEN part < size THEN part ELSE 0 END)::BIGINT AS cut
    FROM met"""
