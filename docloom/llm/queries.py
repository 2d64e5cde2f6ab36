"""The registered queries of this subpackage and the SQL that checks them, where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import collocations, decontaminate, divergence, minhash, mixing, pieces, pii, quotes, secrets, sharding, suffixes, toxicity, vectors
from docloom.llm.common import table
from docloom.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


@_query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query
def op2_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


ORACLES["op2_vectors"] = vectors.ORACLE


@_query
def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and whether decoding them gives the text back."""
    vocabulary = pieces.Vocabulary.load()
    coded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary, decoded="decoded")
    return coded.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), F.octet_length("text").cast("long").alias("n_bytes"),
                        F.col("decoded").eqNullSafe(F.col("text")).alias("exact"), "tokens")


@_query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.digest(pii.find(docs, pii.fit_field(docs)))


@_query
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


@_query
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


ORACLES["op6_minhash"] = minhash.ORACLE


@_query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit_model(docs, table(spark, sf_dir, "labels")))


@_query
def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"), batches=3).drop("kept")


@_query
def op9_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.thread(table(spark, sf_dir, "conversations"))


@_query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(table(spark, sf_dir, "documents"), shards=24)


@_query
def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents"))


ORACLES["op11_mixing"] = mixing.ORACLE


@_query
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLES["op12_divergence"] = divergence.ORACLE


@_query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLES["op13_collocations"] = collocations.ORACLE
