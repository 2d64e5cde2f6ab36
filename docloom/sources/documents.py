"""Reading documents, table rows, pages and file layouts."""

from __future__ import annotations

from collections.abc import Sequence
from html import unescape

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from docloom import fixed_values as V
from docloom.functions import text as tx
from docloom.operators.ensemble import union_hits
from docloom.operators.numbering import limit_sorted, row_positions
from docloom.sources import quoted


def read_documents(spark: SparkSession, path: str, suffixes: Sequence[str] = (".txt", ".csv"),
                   text: str = "text") -> DataFrame:
    """Documents of one folder, each stamped with its file name as ``source``.

    ``.txt`` files are one document each, ``.csv`` files one per row. Binary
    formats arrive decoded as ``.parquet`` with a text column; the other columns
    are kept.
    """
    frames = []
    for suffix in suffixes:
        reader = spark.read.option("pathGlobFilter", f"*{suffix}")
        try:
            if suffix == ".csv":
                found = _csv_documents(spark, path)
            elif suffix == ".parquet":
                raw = reader.parquet(path)
                rest = [c for c in raw.columns if c not in (text, "source", "content")]
                found = raw.select(*rest, F.col(text).alias("content"), F.col("_metadata.file_name").alias("source"))
            else:
                found = reader.text(path, wholetext=True).select(
                    F.col("value").alias("content"), F.col("_metadata.file_name").alias("source"))
        except AnalysisException as problem:  # nothing with this suffix: no schema to infer
            if problem.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            continue
        frames.append(found)
    frames = [f for f in frames if f.columns and not f.isEmpty()]
    if not frames:
        raise ValueError(f"no documents with {list(suffixes)} found in {path}")
    return union_hits(*frames)


def _csv_documents(spark: SparkSession, path: str) -> DataFrame:
    """One document per CSV row, under the column names of its own file; one read, whatever the headers."""
    rows = quoted.with_header(quoted.csv_records(spark, path, "*.csv"))
    named = F.transform(quoted.cells("header"), tx.strip)
    line = lambda name, i: F.concat(name, F.lit(": "), tx.strip(F.coalesce(F.get("cells", i), F.lit(""))))
    split = rows.select("name", named.alias("names"), quoted.cells("text").alias("cells"))
    return split.select(F.array_join(F.transform("names", line), "\n").alias("content"), F.col("name").alias("source"))


def row_text(cols: Sequence[str]) -> Column:
    """``column: value`` lines in column order."""
    return F.array_join(F.array(*[
        F.concat(F.lit(f"{c.strip()}: "), tx.strip(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))))
        for c in cols]), "\n")


def rows_to_documents(df: DataFrame, order_by: str, bucket: Sequence[Column]) -> DataFrame:
    """One document per table row with its 0-based row number."""
    return row_positions(df, [], [order_by], bucket, "row").select("row", row_text(df.columns).alias("content"))


def supported(path: Column, suffixes: Sequence[str] = tuple(V.EXTRACTABLE_SUFFIXES)) -> Column:
    return tx.suffix(path).isin(*suffixes)


def filter_ext(df: DataFrame, path: str, suffixes: Sequence[str] = tuple(V.EXTRACTABLE_SUFFIXES)) -> DataFrame:
    return df.where(supported(F.col(path), suffixes))


def join_paragraphs(df: DataFrame, text: str = "text") -> DataFrame:
    """Stripped, non-empty paragraphs with blank lines between; empty documents dropped."""
    return df.withColumn("content", tx.paragraphs_joined(F.col(text))).where(F.col("content") != "")


def scan_layout(spark: SparkSession, root: str, pattern: str, cap: int | None = None) -> DataFrame:
    """Distinct files of a folder layout in path order; contents are not read."""
    try:
        found = spark.read.format("binaryFile").load(f"{root}/{pattern}")
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            raise ValueError(f"no files found under {root}; expected {pattern}") from problem
        raise
    return limit_sorted(found.select("path", "length").distinct(), ["path"], cap)


def with_path_ids(df: DataFrame, path: str = "path") -> DataFrame:
    return df.withColumn("doc_id", tx.grandparent(F.col(path))).withColumn("item_id", tx.stem(F.col(path)))


# Elements without visible text, elements that end a line, what may stand inside a tag.
SILENT = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
BLOCK_TAGS = (r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|figure|footer|form|h[1-6]|head|"
              r"header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul)\b")
INSIDE = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""


def _decoded(text: pd.Series) -> pd.Series:
    """Every named and numeric character reference; a space that must not break counts as one."""
    return text.map(lambda t: t if t is None or "&" not in t else unescape(t).replace("\u00a0", " "))


def text_blocks(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Non-empty text blocks of HTML pages in document order."""
    c = F.regexp_replace(F.col(html), SILENT, "")
    c = F.replace(c, F.lit("\n"), F.lit(" "))
    # Quoted attributes may hold a closing bracket; a tag whose quotes do not close ends at the first one.
    for inside in (INSIDE, "[^>]*>"):
        c = F.regexp_replace(F.regexp_replace(c, BLOCK_TAGS + inside, "\n"), f"<[a-zA-Z/!?]{inside}", "")
    c = pandas_udf(_decoded, "string")(c)
    blocks = F.filter(F.transform(F.split(c, "\n"), tx.strip), lambda b: b != "")
    return pages.select(key, F.posexplode(blocks).alias("block_index", "block"))


def with_data_url(df: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    return df.withColumn("data_url", tx.data_url(F.col(path), F.col(content), V.IMAGE_MIME))


def nest_columns(df: DataFrame, sep: str = ".") -> DataFrame:
    """Dotted flat columns (``vitals.spo2``) to structs, in first-seen order."""
    groups: dict[str, list[str]] = {}
    for c in df.columns:
        groups.setdefault(c.split(sep, 1)[0], []).append(c)
    return df.select(*[
        F.struct(*[F.col(f"`{c}`").alias(c.split(sep, 1)[1]) for c in cols]).alias(name)
        if any(sep in c for c in cols) else F.col(f"`{name}`")
        for name, cols in groups.items()
    ])


def explode_list(df: DataFrame, column: str, out: str = "item") -> DataFrame:
    """One row per item of a comma list; commas inside parentheses do not split."""
    return df.withColumn(out, F.explode(tx.split_outside_parens(F.col(column))))
