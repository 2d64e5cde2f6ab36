"""The corpus pipeline: cleaning stages, each over everything its predecessor kept.

Toxic documents go, one document of each group of near copies stays, documents with benchmark passages
go, secrets are blacked out, and what is left is encoded and decoded. All but the last stage return the columns of
``documents``. SQL cannot express the classifier or the hashes; the tests hold each stage against plain Python.

Null and empty texts pass every stage. Rows with a null id pass where a decision goes by id; rows that repeat an id stay or go
together there. An empty table gives an empty result, and other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import decontaminate, minhash, pieces, secrets, toxicity
from docloom.llm.common import free_name, saved, table
from docloom.session import ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below 0.5; it learns from labelled documents that are not held out."""
    ship_package(spark)
    return toxicity.keep_clean(docs, toxicity.fit_model(docs, table(spark, sf_dir, "labels")))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies: five-word shingles, similarity 0.8."""
    ship_package(spark)
    return minhash.keep_first(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage like a benchmark item."""
    ship_package(spark)
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its secrets blacked out and its length counted anew."""
    ship_package(spark)
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its piece ids, their number, and as text what they decode to.

    A null text has null pieces. A column that is called like one of the new ones gives way to it.
    """
    ship_package(spark)
    vocabulary = pieces.Vocabulary.load()
    docs = docs.drop("tokens", "n_tokens", "exact")
    back = free_name(docs, "decoded")
    coded = pieces.encode(docs, vocabulary, decoded=back)
    exact = F.col(back).eqNullSafe(F.col("text"))
    return coded.select(*[F.col(back).alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns],
                        "tokens", F.size("tokens").cast("long").alias("n_tokens"), exact.alias("exact"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("pieces", encode_pieces),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each one's result written and read again."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
