"""Splitting texts and tables into chunks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udtf

from docloom import fixed_values as V
from docloom.functions import text as tx
from docloom.operators.numbering import row_positions


def check_sizes(size: int, overlap: int) -> None:
    if size < 1 or not 0 <= overlap < size:
        raise ValueError(f"a chunk of {size} cannot share {overlap} with the next; sizes start at 1, shares lie below the size")


# --- recursive splitting -------------------------------------------------------

Span = tuple[int, int]


def _cut(text: str, span: Span, sep: str) -> list[Span]:
    """Pieces of a span, each later piece starting with its separator."""
    lo, hi = span
    edges, at = [lo], text.find(sep, lo, hi)
    while at >= 0:
        edges.append(at)
        at = text.find(sep, at + len(sep), hi)
    edges.append(hi)
    return [(a, b) for a, b in zip(edges, edges[1:]) if b > a]


def _slide(span: Span, size: int, overlap: int) -> Iterator[Span]:
    """Character windows: what packing single characters comes to, without listing them."""
    lo, hi = span
    while hi - lo > size:
        yield lo, lo + size
        lo += size - overlap
    if hi > lo:
        yield lo, hi


def _pack(pieces: list[Span], size: int, overlap: int) -> Iterator[Span]:
    """Greedy windows over adjacent pieces; a window slides on by whole pieces."""
    first = 0
    for i, (_, end) in enumerate(pieces):
        if i > first and end - pieces[first][0] > size:
            yield pieces[first][0], pieces[i - 1][1]
            done = pieces[i - 1][1]
            while first < i and (done - pieces[first][0] > overlap or end - pieces[first][0] > size):
                first += 1
    if first < len(pieces):
        yield pieces[first][0], pieces[-1][1]


def _spans(text: str, span: Span, size: int, overlap: int, seps: Sequence[str]) -> Iterator[Span]:
    lo, hi = span
    level = next((i for i, s in enumerate(seps) if not s or text.find(s, lo, hi) >= 0), len(seps) - 1)
    if not seps[level]:
        yield from _slide(span, size, overlap)
        return
    rest = seps[level + 1:]
    small: list[Span] = []
    for piece in _cut(text, span, seps[level]):
        if piece[1] - piece[0] < size:
            small.append(piece)
            continue
        yield from _pack(small, size, overlap)
        small = []
        if rest:
            yield from _spans(text, piece, size, overlap, rest)
        else:
            yield piece
    yield from _pack(small, size, overlap)


def recursive_chunks(
    text: str | None, size: int, overlap: int, seps: Sequence[str]
) -> Iterator[tuple[int, int, str]]:
    """(index, start offset, stripped chunk) of one text; blank chunks are skipped."""
    index = 0
    for lo, hi in _spans(text or "", (0, len(text or "")), size, overlap, seps):
        raw = text[lo:hi]
        chunk = raw.strip()
        if chunk:
            yield index, lo + len(raw) - len(raw.lstrip()), chunk
            index += 1


CHUNKS_AT_ONCE = 8_192  # rows per output batch, so that huge documents stream out
CHUNK_FIELDS = [
    T.StructField("chunk_index", T.IntegerType()),
    T.StructField("start", T.IntegerType()),
    T.StructField("content", T.StringType()),
]


def chunk_text(
    df: DataFrame,
    size: int = V.CHUNK_SIZE,
    overlap: int = V.CHUNK_OVERLAP,
    seps: Sequence[str] = tuple(V.SEPARATORS),
    text: str = "text",
    keep: Sequence[str] = ("doc_id", "source"),
) -> DataFrame:
    """Recursive character split; the kept columns are copied to every chunk."""
    check_sizes(size, overlap)
    keep = list(keep)
    schema = T.StructType([df.schema[c] for c in keep] + CHUNK_FIELDS)
    arrow_fields = [pa.field("chunk_index", pa.int32()), pa.field("start", pa.int32()),
                    pa.field("content", pa.string())]

    def emit(batch: pa.RecordBatch, found: list[tuple]) -> pa.RecordBatch:
        rows, *cols = zip(*found) if found else ([], [], [], [])
        kept = batch.select(range(len(keep))).take(pa.array(rows, pa.int32()))
        return pa.RecordBatch.from_arrays(
            [*kept.columns, *[pa.array(c, f.type) for c, f in zip(cols, arrow_fields)]],
            schema=pa.schema([*kept.schema, *arrow_fields]),
        )

    def split(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            found: list[tuple] = []
            for i in range(len(batch)):
                value = batch.column(len(keep))[i].as_py()
                for chunk in recursive_chunks(value, size, overlap, seps):
                    found.append((i, *chunk))
                    if len(found) >= CHUNKS_AT_ONCE:
                        yield emit(batch, found)
                        found = []
            yield emit(batch, found)

    return df.select(*keep, text).mapInArrow(split, schema)


def register_chunker(spark: SparkSession, name: str = "chunk", keep: str = "doc_id BIGINT", text: str = "text") -> None:
    """Make the splitter callable from SQL: ``SELECT * FROM chunk(TABLE(t), 500, 50)``.

    ``keep`` lists columns of the table, in DDL form, that are copied to every chunk. Works on Arrow batches where the rows
    lie; Spark 4.1 lets an Arrow table function take a table, but neither LATERAL nor ask for its columns at analysis.
    """
    kept = T.StructType.fromDDL(keep)

    class Chunk:
        def eval(self, table: pa.RecordBatch, size: int, overlap: int):
            size, overlap = (x[0].as_py() if isinstance(x, (pa.Array, pa.ChunkedArray)) else x for x in (size, overlap))
            check_sizes(size, overlap)
            missing = [c for c in [*kept.names, text] if c not in table.schema.names]
            if missing:
                raise ValueError(f"the table lacks {missing}; it has {table.schema.names}")
            rows, column = table.select(kept.names), table.column(text)
            found: list[tuple] = []
            for i in range(table.num_rows):
                for chunk in recursive_chunks(column[i].as_py(), size, overlap, V.SEPARATORS):
                    found.append((i, *chunk))
                    if len(found) >= CHUNKS_AT_ONCE:
                        yield _chunk_table(rows, found)
                        found = []
            if found:
                yield _chunk_table(rows, found)

    spark.udtf.register(name, arrow_udtf(Chunk, returnType=T.StructType(kept.fields + CHUNK_FIELDS)))


def _chunk_table(kept: pa.RecordBatch, found: list[tuple]) -> pa.Table:
    """The kept columns of each chunk's row beside the chunk."""
    rows, index, start, content = zip(*found)
    columns = {f.name: kept.column(i).take(pa.array(rows, pa.int32())) for i, f in enumerate(kept.schema)}
    return pa.table({**columns, "chunk_index": pa.array(index, pa.int32()), "start": pa.array(start, pa.int32()), "content": pa.array(content, pa.string())})


# --- fixed windows ---------------------------------------------------------------


def last_window(n: Column, size: int, overlap: int) -> Column:
    """0-based number of the last window over n items."""
    return F.greatest(F.lit(0), F.ceil((n - size) / F.lit(size - overlap))).cast("int")


def chunk_fixed(
    df: DataFrame,
    size: int = V.CHUNK_SIZE,
    overlap: int = V.CHUNK_OVERLAP,
    text: str = "text",
    keep: Sequence[str] = ("doc_id", "source"),
) -> DataFrame:
    """Fixed character windows with overlap.

    One pass cuts the text into steps; a window is its step and the start of the
    following ones. (Taking each window by its offset would walk the text from the
    beginning every time, which is quadratic in long documents.)
    """
    check_sizes(size, overlap)
    step = size - overlap
    steps = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    reach = -(-size // step)
    cut = df.where(F.length(text) > 0).select(
        *keep, steps.alias("_steps"), last_window(F.length(text), size, overlap).alias("_last"))
    windows = F.transform(
        F.sequence(F.lit(0), F.col("_last")),
        lambda c: F.substring(F.array_join(F.slice("_steps", c + 1, F.lit(reach)), ""), 1, size))
    return cut.select(*keep, F.posexplode(windows).alias("chunk_index", "content")).select(
        *keep, "chunk_index", (F.col("chunk_index") * step).alias("start"), "content")


def chunk_stats(chunks: DataFrame, by: str = "source") -> DataFrame:
    n = F.length("content")
    return chunks.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_chunks"), F.min(n).alias("min_chars"),
        F.avg(n).alias("avg_chars"), F.max(n).alias("max_chars"),
    )


def with_chunk_uid(chunks: DataFrame, doc: str = "doc_id", source: str = "source",
                   index: str = "chunk_index_global") -> DataFrame:
    """Content-dependent id; pass a per-document index to keep ids when other documents change."""
    return chunks.withColumn(
        "chunk_uid", tx.stable_id(F.col(doc), F.col(source), F.col(index), F.col("content"))
    )


# --- row groups of tables ------------------------------------------------------------


def strip_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[str(c).strip() for c in df.columns])


def chunk_rows(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    bucket: Sequence[Column],
    size: int = V.ROWS_PER_CHUNK,
    overlap: int = V.ROW_OVERLAP,
) -> DataFrame:
    """Each row once per row group that holds it.

    Adds ``row_number`` (0-based), ``chunk_index_in_table`` (1-based),
    ``row_start``, ``row_end_exclusive`` and ``total_rows``.
    """
    check_sizes(size, overlap)
    step = size - overlap
    placed = row_positions(df, partition_by, order_by, bucket, "row_number", total="total_rows")
    r = F.col("row_number")
    last = last_window(F.col("total_rows"), size, overlap)
    lo = F.greatest(F.lit(0), F.ceil((r - size + 1) / F.lit(step))).cast("int")
    hi = F.least(F.floor(r / F.lit(step)).cast("int"), last)
    c = F.col("_chunk")
    return (
        placed.withColumn("_chunk", F.explode(F.sequence(lo, hi)))
        .withColumn("chunk_index_in_table", c + 1)
        .withColumn("row_start", (c * step).cast("int"))
        .withColumn("row_end_exclusive", F.least((c * step + size).cast("long"), F.col("total_rows")).cast("int"))
        .drop("_chunk")
    )


def _cells(cols: Sequence[str]) -> Column:
    return F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def markdown_row(cols: Sequence[str]) -> Column:
    return F.concat(F.lit("| "), F.array_join(_cells(cols), " | "), F.lit(" |"))


def csv_row(cols: Sequence[str]) -> Column:
    return F.to_csv(F.struct(*cols), {"escape": '"'})


def table_head(cols: Sequence[str], form: str) -> str:
    if form == "markdown":
        return "| " + " | ".join(cols) + " |\n|" + "|".join([" --- "] * len(cols)) + "|\n"
    if form == "csv":
        return ",".join(cols) + "\n"
    raise ValueError(f"no table form {form!r}; there are markdown and csv")


def rows_to_text(
    grouped_rows: DataFrame, chunk_key: Sequence[str], cols: Sequence[str], form: str = "markdown"
) -> DataFrame:
    """One text per row group: header line(s), then its rows in order.

    A row group holds at most ``size`` rows, so the list per key is bounded.
    """
    head = table_head(cols, form)
    line = markdown_row(cols) if form == "markdown" else csv_row(cols)
    lines = F.array_sort(F.collect_list(F.struct(F.col("row_number").alias("r"), line.alias("line"))))
    body = F.array_join(F.transform(lines, lambda x: x["line"]), "\n")
    return grouped_rows.groupBy(*chunk_key).agg(F.concat(F.lit(head), body).alias("body"))


def table_documents(
    df: DataFrame,
    doc: str,
    table: str,
    order_by: Sequence[str],
    bucket: Sequence[Column],
    cols: Sequence[str],
    size: int = V.ROWS_PER_CHUNK,
    overlap: int = V.ROW_OVERLAP,
    form: str = "markdown",
) -> DataFrame:
    """Row-group chunks with their describing header, metadata and stable ``vector_id``."""
    rows = chunk_rows(df, [doc, table], order_by, bucket, size, overlap)
    key = [doc, table, "chunk_index_in_table", "row_start", "row_end_exclusive", "total_rows"]
    bodies = rows_to_text(rows, key, cols, form)
    header = tx.fill_template(V.TABLE_HEADER, {
        "doc_id": F.col(doc), "table_id": F.col(table), "first": F.col("row_start"),
        "last": F.col("row_end_exclusive") - 1, "total": F.col("total_rows"), "columns": F.lit(", ".join(cols))})
    return bodies.select(
        *key,
        F.lit(len(cols)).alias("n_cols"),
        F.lit(form).alias("serialize_as"),
        F.lit("table").alias("modality"),
        tx.stable_id(F.col(doc), F.col(table), F.col("row_start"), F.col("row_end_exclusive"),
                     F.lit(form)).alias("vector_id"),
        F.concat(header, F.col("body")).alias("content"),
    )
