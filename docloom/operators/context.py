"""Contexts, prompts and answers built from ranked hits."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from docloom import fixed_values as V
from docloom.functions import text as tx
from docloom.operators.ensemble import chunk_ref, source_hint


def shown(c: Column) -> Column:
    """A value as printed in headers; a missing one reads None."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def shown_float(c: Column) -> Column:
    """A float as printed in headers: plain digits also for small values."""
    digits = c.cast("decimal(30,20)").cast("string")
    plain = F.regexp_replace(F.regexp_replace(digits, r"0+\z", ""), r"\.\z", ".0")
    return F.when(c.isNull(), "None").when((F.abs(c) >= 1e-3) | (c == 0), c.cast("string")).otherwise(plain)


def block_header(style: str, rank: str) -> Column:
    if style not in V.CONTEXT_HEADERS:
        raise ValueError(f"style must be one of {sorted(V.CONTEXT_HEADERS)}")
    values = {"rank": F.col(rank)}
    if style == "source":
        values["source"] = tx.first_filled(F.col("source"), default="Unknown")
    if style == "index":
        values |= {
            "chunk_id": chunk_ref(), "modality": shown(F.col("modality")), "doc_id": shown(F.col("doc_id")),
            "hint": source_hint(), "score": shown_float(F.col("retrieval_score")),
            "rerank": shown_float(F.col("rerank_score")),
        }
    return tx.fill_template(V.CONTEXT_HEADERS[style], values)


def joined_in_order(rank: str, value: Column, sep: str) -> Column:
    """Aggregate: values in rank order, joined. For groups bounded by a rank cut."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), value.alias("v"))))
    return F.array_join(F.transform(ordered, lambda x: F.coalesce(x["v"], F.lit(""))), sep)


def build_context(hits: DataFrame, style: str = "numbered", query: Sequence[str] = ("query_id",),
                  rank: str = "rank", content: str = "content") -> DataFrame:
    block = F.concat(block_header(style, rank), F.lit("\n"), F.coalesce(F.col(content), F.lit("")))
    return hits.groupBy(*query).agg(joined_in_order(rank, block, V.BLOCK_JOINER).alias("context"))


def pack_contexts(hits: DataFrame, query: str = "query_id", rank: str = "rank", content: str = "content",
                  source: str = "source", style: str | None = None) -> DataFrame:
    """Contents and sources of a hit list in rank order; with a style the prompt's context as well, in the same pass."""
    named = tx.first_filled(F.col(source), default="Unknown")
    texts = [joined_in_order(rank, F.col(content), V.CONTEXT_JOINER).alias("contexts_joined"),
             joined_in_order(rank, named, V.SOURCE_JOINER).alias("sources")]
    if style:
        block = F.concat(block_header(style, rank), F.lit("\n"), F.coalesce(F.col(content), F.lit("")))
        texts.append(joined_in_order(rank, block, V.BLOCK_JOINER).alias("context"))
    return hits.groupBy(query).agg(*texts)


def unpack_contexts(df: DataFrame) -> DataFrame:
    """Back to arrays; the joiners are taken literally."""
    return df.withColumn("contexts", F.split("contexts_joined", r"\Q" + V.CONTEXT_JOINER + r"\E")).withColumn(
        "source_list", F.split("sources", r"\Q" + V.SOURCE_JOINER + r"\E"))


def sources_used(hits: DataFrame, query: str = "query_id", rank: str = "rank", source: str = "source") -> DataFrame:
    """Sources in rank order, each once, at its best rank."""
    best = hits.groupBy(query, source).agg(F.min(rank).alias("_r"))
    return best.groupBy(query).agg(
        joined_in_order("_r", F.col(source), V.SOURCE_JOINER).alias("sources"),
        F.count(F.lit(1)).alias("n_sources"),
    )


def rag_prompt(style: str, question: Column, context: Column) -> Column:
    """Grounded prompt in one of three layouts, or the plain question."""
    if style not in V.PROMPTS:
        raise ValueError(f"style must be one of {sorted(V.PROMPTS)}")
    return tx.fill_template(V.PROMPTS[style], {"question": question, "context": context})


def extractive_answer(question: Column, context: Column, fallback: str = V.FALLBACK_EVAL) -> Column:
    """The context sentence that shares most distinct tokens with the question; the first wins ties."""
    asked = F.array_distinct(tx.tokens(question))
    sentences = F.filter(F.transform(F.split(context, r"(?<=[.!?])\s+|\n+"), tx.strip), lambda s: s != "")
    rated = F.transform(sentences, lambda s, i: F.struct(
        F.size(F.array_intersect(asked, tx.tokens(s))).alias("hits"), (-i).alias("place"), s.alias("sentence")))
    best = F.array_max(rated)
    return F.when(best["hits"] > 0, best["sentence"]).otherwise(F.lit(fallback))


def answer(df: DataFrame, question: str = "question", context: str = "context",
           completer: Callable[[list[str]], list[str]] | None = None, prompt: str = "prompt") -> DataFrame:
    """Fill ``prediction``; ``completer`` maps a batch of prompts to texts inside the tasks."""
    if completer is None:
        return df.withColumn("prediction", extractive_answer(F.col(question), F.col(context)))

    @pandas_udf(T.StringType())
    def apply(prompts: pd.Series) -> pd.Series:
        return pd.Series(completer(prompts.fillna("").tolist()))

    return df.withColumn("prediction", apply(F.col(prompt)))


PAYLOAD_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("key_text", T.ArrayType(T.StringType())),
    T.StructField("entities", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()), T.StructField("role", T.StringType())]))),
    T.StructField("relations", T.ArrayType(T.StructType([
        T.StructField("from", T.StringType()), T.StructField("to", T.StringType()),
        T.StructField("relation", T.StringType())]))),
    T.StructField("numbers", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType()), T.StructField("value", T.StringType()),
        T.StructField("unit", T.StringType())]))),
    T.StructField("warnings", T.ArrayType(T.StringType())),
    T.StructField("_corrupt_record", T.StringType()),
])


def parse_payload(content: Column) -> Column:
    """Typed image description; ``_corrupt_record`` is set for text that is not such a record."""
    return F.from_json(content, PAYLOAD_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt_record"})


def readable_payload(content: Column) -> Column:
    """The typed record, or NULL for text that is none."""
    p = parse_payload(content)
    return F.when(p.isNotNull() & p["_corrupt_record"].isNull(), p.dropFields("_corrupt_record"))


def json_text(*columns: str) -> Column:
    """The columns as one JSON text, in the given order; missing values are left out."""
    return F.to_json(F.struct(*columns))


def metadata_subset(metadata: Column, keys: Sequence[str]) -> Column:
    """The entries of a metadata map under the wanted keys; keys that are absent stay absent."""
    return F.map_filter(metadata, lambda k, v: k.isin(*keys))


def drop_control_words(df: DataFrame, text: str = "query") -> DataFrame:
    """Messages that are not one of the words that end a session, whatever their case."""
    return df.where(~F.lower(text).isin(*V.CONTROL_WORDS))


def _listed(name: str, items: Column, n: int) -> Column:
    text = F.array_join(F.slice(items, 1, n), "; ")
    return F.when(F.coalesce(F.size(items), F.lit(0)) > 0, F.concat(F.lit(f"{name}: "), text)).otherwise(
        F.lit(f"{name}: (none)"))


def render_chunk() -> Column:
    """Readable form of a hit: a header and its text, or the fields of an image description."""
    header = tx.fill_template(V.CHUNK_HEADER, {
        "chunk_id": chunk_ref(), "modality": F.coalesce(F.col("modality"), F.lit("unknown")),
        "doc_id": F.coalesce(F.col("doc_id").cast("string"), F.lit("N/A")),
        "score": shown_float(F.col("retrieval_score"))})
    p = parse_payload(F.col("content"))
    readable = p.isNotNull() & p["_corrupt_record"].isNull()
    summary = tx.strip(F.concat(F.lit("summary: "), F.coalesce(p["summary"], F.lit(""))))
    fields = F.concat_ws("\n", header, summary, _listed("key_text", p["key_text"], 10),
                         _listed("warnings", p["warnings"], 5))
    plain = F.concat(header, F.lit("\n"), tx.safe_preview(F.col("content"), 900))
    return F.when(F.col("modality").isin("image_vlm", "image_ocr") & readable, fields).otherwise(plain)


def assemble_sections(df: DataFrame, key: str, order: str, name: str, content: str) -> DataFrame:
    """``## name`` and content per section, in section order (a short fixed list per document)."""
    block = F.concat(F.lit("## "), F.col(name), F.lit("\n"), F.coalesce(F.col(content), F.lit("")))
    return df.groupBy(key).agg(joined_in_order(order, block, V.BLOCK_JOINER).alias("proposal"))
