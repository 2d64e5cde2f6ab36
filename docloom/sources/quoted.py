"""CSV files whose quoted cells hold line breaks, read by many tasks.

A line break ends a record only outside quotes, so a task that starts inside a file has to know whether it starts inside
quotes. Quotes are doubled within quotes, hence every quote mark switches between inside and outside: the parity of the marks
before a line says where it begins. Each block of a file counts its marks, a running sum over one short row per block
gives the parity at its start, and the lines of a block follow from there. Lines of one record, also those that
lie in several blocks, are put together again.
"""

from __future__ import annotations

import csv
import io

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from docloom.session import written

# A missing cell is written as nothing and an empty one as two quotes; the mark for missing cells must differ from both.
CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "nullValue": "\u0000", "emptyValue": ""}


def csv_records(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """(file, name, block, record, text): the records of all files, numbered by the block they begin in; blank lines are none.

    Marks stand around cells or doubled within them. A mark left open takes the rest of its file into one record.
    """
    reader = spark.read.option("lineSep", "\n")
    raw = (reader.option("pathGlobFilter", glob) if glob else reader).text(path)
    lines = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"),
                       F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    lines = lines.withColumn("marks", F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))))
    of_block, earlier = ["file", "block"], Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    open_ = lines.groupBy(*of_block).agg(F.sum("marks").alias("marks")).select(*of_block, F.coalesce(F.sum("marks").over(earlier), F.lit(0)).alias("before"))
    in_block = Window.partitionBy(*of_block).orderBy("at")
    passed = F.coalesce(F.sum("marks").over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = lines.join(open_, of_block).withColumn("begins", ((F.col("before") + passed) % 2 == 0).cast("int"))
    placed = placed.withColumn("record", F.sum("begins").over(in_block.rowsBetween(Window.unboundedPreceding, 0))).drop("before", "begins", "marks")
    # Lines before the first record of a block go on with the last record that began in a block before.
    begun = placed.groupBy(*of_block).agg(F.max("record").alias("begun"))
    last = F.last(F.when(F.col("begun") > 0, F.struct("block", "begun")), ignorenulls=True).over(earlier)
    owned = placed.join(begun.select(*of_block, last.alias("owner")), of_block)
    goes_on = F.col("record") == 0
    owned = owned.select("file", "name", F.when(goes_on, F.col("owner.block")).otherwise(F.col("block")).alias("own"),
                         F.when(goes_on, F.col("owner.begun")).otherwise(F.col("record")).alias("record"), "block", "at", "value")
    parts = F.array_sort(F.collect_list(F.struct("block", "at", "value")))
    whole = owned.groupBy("file", "name", F.col("own").alias("block_"), "record").agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("text"))
    text = F.regexp_replace(F.regexp_replace("text", r"\r\z", ""), r"\A\x{FEFF}", "")
    # Written, since headers and rows both come from it.
    return written(whole.select("file", "name", F.col("block_").alias("block"), "record", text.alias("text")).where("text <> ''"), "records")


def with_header(records: DataFrame) -> DataFrame:
    """All records but the first of each file, with that one as ``header``."""
    first = records.groupBy(F.col("file").alias("_file")).agg(F.min(F.struct("block", "record", "text")).alias("_first"))
    rest = records.join(first, F.col("file") == F.col("_file"))
    rest = rest.where((F.col("block") != F.col("_first.block")) | (F.col("record") != F.col("_first.record")))
    return rest.select(*records.columns, F.col("_first.text").alias("header"))


@pandas_udf(T.ArrayType(T.StringType()))
def cells(records: pd.Series) -> pd.Series:
    """The cells of each record; missing and empty ones alike."""
    return records.map(lambda r: None if r is None else next(csv.reader(io.StringIO(r, newline=""), strict=False), []))


def parsed(text: str | Column, schema: T.StructType) -> Column:
    """A record as a struct, cell by cell in order of the schema; a missing cell is null, an empty one empty."""
    kinds = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    return F.from_csv(text, kinds, {k: str(v) for k, v in CSV.items() if k != "header"})


def headers(rows: DataFrame) -> list[str] | None:
    """The columns that all files share; an error if they do not, nothing if there is no record."""
    found = rows.select("header").distinct().limit(2).collect()
    if len(found) > 1:
        raise ValueError("files of one table have different headers")
    return next(csv.reader(io.StringIO(found[0].header, newline=""))) if found else None
