"""The registered queries of this subpackage on the small tables."""

import re

import __spark_entry__ as entry
import corpus_pipeline
from docloom.llm.queries import QUERIES


def test_every_operator_has_one_query():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and corpus_pipeline.ORACLE_SQL is None


def test_shapes_on_the_small_tables(spark, sf):
    want = {
        "op2_vectors": {"vec_id", "n_links", "component_id", "kept"}, "op4_pii": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
        "op5_secrets": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"}, "op6_minhash": {"doc_id", "n_shingles", "component_id", "kept"},
        "op7_toxicity": {"doc_id", "held_out", "score", "predicted"}, "op8_suffixes": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
        "op10_sharding": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    }
    docs, vectors = (spark.read.parquet(f"{sf}/{t}.parquet").count() for t in ("documents", "embeddings"))
    for name, columns in want.items():
        out = QUERIES[name](spark, sf)
        assert columns <= set(out.columns) and out.count() == (vectors if name == "op2_vectors" else docs), name
