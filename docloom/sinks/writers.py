"""Writing tables, manifests, artifacts and traces. Every write is one Spark job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom import fixed_values as V
from docloom.functions import text as tx
from docloom.operators import measure
from docloom.operators.context import joined_in_order, render_chunk, shown_float
from docloom.session import scratch_path

# Cells keep their own white space; an empty text differs from a missing one.
CSV = {"header": True, "quote": '"', "escape": '"', "emptyValue": '""',
       "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def export_tables(df: DataFrame, out: str, doc: str = "doc_id", table: str = "table_index") -> DataFrame:
    """All tables as CSV by document and table, and as Parquet for SQL; returns index, name, rows, columns.

    A table that was exported before is replaced, every other one stays. The rows are
    computed once: the counts and the CSV come from what was stored.
    """
    spark = df.sparkSession
    cols = [c for c in df.columns if c not in (doc, table)]
    fresh = scratch_path(spark, "tables")
    df.write.parquet(fresh)
    stored = spark.read.schema(df.schema).parquet(fresh)
    for folder, form, options in (("sql", "parquet", {}), ("csv", "csv", CSV)):
        stored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(doc, table).options(
            **options).format(form).save(f"{out}/{folder}")
    counted = stored.groupBy(doc, table).agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(doc, table, table_name(doc, table).alias("sql_table"), "rows", F.lit(len(cols)).alias("cols"))


def table_name(doc: str, table: str):
    return tx.safe_name(F.format_string("%s__table_%03d", F.col(doc).cast("string"), F.col(table).cast("int")))


def table_view(spark: SparkSession, out: str, doc: str, table: int, name: str) -> DataFrame:
    """One exported table under its SQL name (partition pruning reads only its files)."""
    view = spark.read.parquet(f"{out}/sql").where((F.col("doc_id") == doc) & (F.col("table_index") == int(table)))
    view = view.drop("doc_id", "table_index")
    view.createOrReplaceTempView(name)
    return view


def manifest(chunks: DataFrame, doc: str | Sequence[str], entry: Sequence[str], size: int = 10_000) -> DataFrame:
    """The entries of each document in order of the first entry column, a number from 0, in parts of ``size``.

    An ordinary document is its part 0; one of any length never meets in one array.
    """
    doc = [doc] if isinstance(doc, str) else list(doc)
    listed = F.array_sort(F.collect_list(F.struct(*entry)))
    part = F.floor(F.col(entry[0]) / size).cast("int").alias("part")
    return chunks.groupBy(*doc, part).agg(F.count(F.lit(1)).alias("n_entries"), listed.alias("entries"))


def item_manifest(items: DataFrame, collection: str, items_per_doc: Sequence[str], n: str) -> DataFrame:
    """Per table or image what an ingest wrote: its collection, its own columns and its number of rows or chunks."""
    return items.groupBy(*items_per_doc).agg(F.sum(n).alias("n_chunks")).select(
        F.lit(collection).alias("collection"), *items_per_doc, "n_chunks")


def write_json(df: DataFrame, out: str) -> None:
    df.write.mode("errorifexists").json(out)


def union_csv_frame(frames: Sequence[DataFrame], order: str = "sorted") -> DataFrame:
    """Rows of all frames over the union of their columns, sorted or in first-seen order."""
    from docloom.operators.ensemble import union_hits

    joined = union_hits(*frames)
    return joined.select(*(sorted(joined.columns) if order == "sorted" else joined.columns))


def write_union_csv(frames: Sequence[DataFrame], out: str, order: str = "sorted") -> bool:
    """Write the union; no file for no rows. Says whether it wrote."""
    joined = union_csv_frame(frames, order)
    if joined.isEmpty():
        return False
    joined.write.mode("errorifexists").options(**CSV).csv(out)
    return True


def candidate_dump(hits: DataFrame, query: str = "query_id", rank: str = "rank") -> DataFrame:
    """The candidates of a query as one text; a rule of dashes follows all but the last."""
    header = tx.fill_template(V.DUMP_HEADER, {
        "rank": F.col(rank), "source": tx.first_filled(F.col("source"), default="Unknown"),
        "distance": F.format_string("%.6f", F.col("score")), "rerank": shown_float(F.col("rerank_score"))})
    block = F.concat(header, F.lit("\n"), F.coalesce(F.col("content"), F.lit("")))
    body = joined_in_order(rank, block, V.DUMP_RULE + "\n\n")
    return hits.groupBy(query).agg(F.concat(F.lit("\n\n"), body).alias("dump"))


def write_text(df: DataFrame, out: str, text: str, by: Sequence[str]) -> None:
    """One text per row, in a folder per key."""
    df.select(*by, F.col(text).alias("value")).write.mode("errorifexists").partitionBy(*by).option(
        "lineSep", "\n").text(out)


def write_run(df: DataFrame, base: str, run_id: str, name: str, by: Sequence[str] = ()) -> str:
    """An artifact of one run under its own folder; an existing one is never overwritten.

    ``run_id`` comes from the caller, so a retried task cannot move the run.
    """
    out = f"{base}/run_{run_id}/{name}"
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*by) if by else writer).json(out)
    return out


#: What a question leaves behind, besides its trace. Fixed names.
ARTIFACTS = ["retrieval_raw.csv", "retrieval_raw.txt", "dedupe_removed.json", "final_context.txt", "final_prompt.txt", "answer.txt"]
RAW_COLUMNS = ["rank", "modality", "doc_id", "chunk_uid", "vector_id", "table_id", "figure_id", "source_docx", "source_csv", "source_image",
               "retrieval_score", "preview"]


def artifact_rows(hits: DataFrame, answers: DataFrame, traces: DataFrame, query: str = "query_id") -> DataFrame:
    """(query, artifact, body): every artifact of every question.

    ``hits`` are the ranked raw hits with ``repeat`` and ``fingerprint``, ``answers`` have context, prompt and prediction.
    """
    row = hits.withColumns({"rank": F.col("ensemble_rank"), "preview": tx.preview(F.col("content"))})
    line = F.to_csv(F.struct(*RAW_COLUMNS), {"quote": '"', "escape": '"'})
    gone = F.struct("ensemble_rank", "fingerprint", "modality", "doc_id", "chunk_id")
    listed = F.array_sort(F.collect_list(F.when(F.col("repeat"), gone)))
    raw = row.withColumns({"_line": line, "_text": render_chunk()}).groupBy(query).agg(
        F.concat(F.lit(",".join(RAW_COLUMNS) + "\n"), joined_in_order("rank", F.col("_line"), "\n")).alias(ARTIFACTS[0]),
        joined_in_order("rank", F.col("_text"), "\n\n").alias(ARTIFACTS[1]), F.to_json(listed).alias(ARTIFACTS[2]))
    told = traces.select(query, F.to_json(F.struct(*[F.col(c) for c in traces.columns]), {"ignoreNullFields": "false"}).alias("trace.json"))
    whole = raw.join(answers.select(query, F.col("context").alias(ARTIFACTS[3]), F.col("prompt").alias(ARTIFACTS[4]), F.col("prediction").alias(ARTIFACTS[5])), query)
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("artifact"), F.col(f"`{n}`").alias("body")) for n in [*ARTIFACTS, "trace.json"]]))
    return whole.join(told, query).select(query, each.alias("_each")).select(query, "_each.*")


def write_artifacts(rows: DataFrame, out: str, query: str = "query_id") -> str:
    """All artifacts of a run in one job, ``q_idx=q_<query>/artifact=<name>``: every one of them, or none.

    Files appear when the whole job commits. A folder that exists is never written to; if the job fails, its own goes.
    """
    named = rows.select(F.concat(F.lit("q_"), F.col(query).cast("string")).alias("q_idx"), "artifact", F.coalesce("body", F.lit("")).alias("value"))
    try:
        named.write.mode("errorifexists").partitionBy("q_idx", "artifact").option("lineSep", "\n").text(out)
    except Exception as problem:
        if not (isinstance(problem, AnalysisException) and problem.getCondition() == "PATH_ALREADY_EXISTS"):
            remove(rows.sparkSession, out)
        raise
    return out


def remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def read_artifacts(spark: SparkSession, out: str) -> DataFrame:
    """(q_idx, artifact, body) of a finished run."""
    found = spark.read.schema("value STRING, q_idx STRING, artifact STRING").text(out, wholetext=True)
    return found.select("q_idx", "artifact", F.regexp_replace("value", r"\n\z", "").alias("body"))


def question_folder(idx):
    return F.format_string("q_%03d", idx)


def sidecar_frame(images: DataFrame, prompt_version: str, path: str = "path", payload: str = "payload") -> DataFrame:
    """One JSON text per image, and the name it belongs under."""
    return images.select(
        F.concat(F.col(path), F.lit(f".{prompt_version}.json")).alias("sidecar_json"),
        F.to_json(F.col(payload)).alias("body"),
    )


def write_eval(df: DataFrame, out: str) -> None:
    df.write.mode("errorifexists").options(**CSV).csv(out)


def trace_frame(counts: DataFrame, config: dict, timings: DataFrame | None = None, tokens: DataFrame | None = None,
                artifacts: dict | None = None, rates=V.UNIT_COSTS, query: str = "query_id", text: str = "question") -> DataFrame:
    """One nested record per query: its text, settings, counts, timings, a cost entry per stage with the rates, artifact paths.

    ``timings(query, seconds per stage...)`` holds what the caller measured; without it the record has no timings.
    ``tokens(query, stage, input_tokens, output_tokens)`` may hold token counts; a stage without any is noted as such.
    ``artifacts`` maps names to path templates in which ``{query}`` stands for the query's id.
    """
    stages = list(V.NOTE_NO_RATE)
    asked = counts.select(query, F.explode(F.array(*[F.lit(s) for s in stages])).alias("stage"))
    if tokens is None:
        asked = asked.withColumns({c: F.lit(None).cast("long") for c in ("input_tokens", "output_tokens")})
    else:
        asked = asked.join(tokens.groupBy(query, "stage").agg(*[F.sum(c).alias(c) for c in ("input_tokens", "output_tokens")]), [query, "stage"], "left")
    entry = F.struct("stage", "input_tokens", "output_tokens", "cost_usd", "note", "rates_used")
    costs = measure.estimate_cost(asked, rates).groupBy(query).agg(
        *[F.max(F.when(F.col("stage") == s, F.to_json(entry, {"ignoreNullFields": "false"}))).alias(f"_{s}") for s in stages])
    cost_kind = "stage string, input_tokens long, output_tokens long, cost_usd double, note string, rates_used map<string,double>"
    rated = F.struct(*[F.lit(rate, ).cast("double").alias(f"{measure.RATE_PREFIX[s]}_cost_per_1k_{side}")
                       for s, pair in rates.items() for side, rate in zip(("input", "output"), pair)])
    spent = [c for c in timings.columns if c != query] if timings is not None else []
    rows = counts.join(costs, query)
    rows = rows if timings is None else rows.join(timings, query, "left")
    columns = [F.col(query), *([F.col(text).alias("query")] if text in counts.columns else []),
               F.struct(*[F.lit(v).alias(k) for k, v in config.items()]).alias("config"),
               F.struct("retrieved_raw", "dedupe_removed", "final_context").alias("counts")]
    if spent:
        columns.append(F.struct(*[F.round(c, 4).alias(c) for c in spent]).alias("timings_sec"))
    columns.append(F.struct(*[F.from_json(f"_{s}", cost_kind).alias(s) for s in stages], rated.alias("rates_config")).alias("cost_placeholders"))
    if artifacts:
        columns.append(F.struct(*[tx.fill_template(path, {"query": F.col(query)}).alias(name) for name, path in artifacts.items()]).alias("artifacts"))
    return rows.select(*columns)
