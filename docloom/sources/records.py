"""Reading chat rows, question sets and stored evaluation results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.operators.numbering import ranged_positions
from docloom.sources import quoted
from docloom.sources.quoted import CSV

MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
REQUIRED = ("question", "answer")

EVAL_SCHEMA = T.StructType([
    T.StructField("idx", T.LongType()), T.StructField("question", T.StringType()),
    T.StructField("ground_truth", T.StringType()), T.StructField("prediction", T.StringType()),
    T.StructField("rougeL_f1", T.DoubleType()), T.StructField("sources", T.StringType()),
    T.StructField("contexts_joined", T.StringType()),
])


def read_chat(spark: SparkSession, path: str, extra: str = "") -> DataFrame:
    """Chat rows ``{"messages": [{role, content}, ...]}``; ``extra`` adds fields in DDL form."""
    fields = [T.StructField("messages", T.ArrayType(MESSAGE))]
    if extra:
        fields = list(T.StructType.fromDDL(extra).fields) + fields
    return spark.read.schema(T.StructType(fields)).json(path)


def read_golden(spark: SparkSession, path: str) -> DataFrame:
    """Golden questions with their 0-based position, by file name and place in the file, as ``idx``. All cells are texts."""
    rows = quoted.with_header(quoted.csv_records(spark, path))
    columns = quoted.headers(rows) or _first_line(spark, path)
    missing = set(REQUIRED) - set(columns)
    if missing:
        raise ValueError(f"golden CSV must contain columns {sorted(REQUIRED)}; found {columns}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return ranged_positions(rows, [], ["name", "file", "block", "record"], "idx").select(quoted.parsed("text", schema).alias("cells"), "idx").select("cells.*", "idx")


def _first_line(spark: SparkSession, path: str) -> list[str]:
    """The columns of a table without rows."""
    return spark.read.csv(path, **CSV).columns


def read_eval(spark: SparkSession, path: str, schema: T.StructType = EVAL_SCHEMA) -> DataFrame:
    """Stored evaluation rows, by place under the given schema; quoted cells may hold line breaks."""
    rows = quoted.with_header(quoted.csv_records(spark, path))
    return rows.select(quoted.parsed("text", schema).alias("cells")).select("cells.*")
