"""Ensembles, fingerprints, contexts, prompts and rendering on small hand-made cases."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from docloom import fixed_values as V
from docloom.operators import context, ensemble
from docloom.plans.retrieval import META, with_metadata


def test_ensemble_ties_and_missing_scores(spark):
    rows = []
    for m in ("image_vlm", "table", "text"):
        rows += [(1, m, 1, 0.5, f"{m}1"), (1, m, 2, 0.7, f"{m}2"), (1, m, 3, None, f"{m}3")]
    rows.append((1, "other", 1, 0.5, "other1"))
    df = spark.createDataFrame(rows, "query_id int, modality string, rank int, score double, name string")
    got = [r.name for r in ensemble.ensemble(df, 9).orderBy("ensemble_rank").collect()]
    assert got == ["text1", "table1", "image_vlm1", "other1", "text2", "table2", "image_vlm2", "text3", "table3"]
    assert ensemble.ensemble(df).count() == V.FINAL_CONTEXT_K


FP_CASES = [
    ({"chunk_uid": "c", "vector_id": "v"}, "chunk_uid::c"),
    ({"chunk_uid": "", "vector_id": "v", "id": "i"}, "vector_id::v"),
    ({"id": "i", "doc_id": "d", "table_id": "t"}, "id::i"),
    ({"doc_id": "d", "table_id": "t", "figure_id": "f"}, "anchor::d::t"),
    ({"doc_id": "d", "table_id": "", "figure_id": "f"}, "anchor::d::f"),
    ({"doc_id": "d", "source_csv": "s.csv", "source_image": "p"}, "anchor::d::s.csv"),
    ({"doc_id": "d", "source_image": "p.png"}, "anchor::d::p.png"),
    ({"doc_id": "d"}, None),
    ({"table_id": "t"}, None),
    ({}, None),
]


def test_fingerprint_branches(spark):
    schema = "n int, content string, " + ", ".join(f"{m} string" for m in META)
    df = spark.createDataFrame([(i, "Some  Text\n", *[case.get(m) for m in META]) for i, (case, _) in enumerate(FP_CASES)], schema)
    got = [r.fp for r in df.select("n", ensemble.fingerprint().alias("fp")).orderBy("n").collect()]
    hashed = "texthash::" + hashlib.sha256(b"some text").hexdigest()[:16]
    assert got == [want or hashed for _, want in FP_CASES]


def test_dedupe_keeps_equal_text_with_different_ids(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, "a"), (2, 1, "a")], "query_id int, rank int, fp string")
    got = {(r.query_id, r["rank"]): r.repeat for r in ensemble.dedupe_small_lists(df, "query_id", "fp", "rank").collect()}
    assert got == {(1, 1): False, (1, 2): False, (1, 3): True, (2, 1): False}


def test_rerank_orders_and_breaks_ties(spark):
    rows = [(1, 1, "q w", "nothing"), (1, 2, "q w", "q w here"), (1, 3, "q w", "also w q"), (1, 4, "q w", "only q")]
    df = spark.createDataFrame(rows, "query_id int, ensemble_rank int, question string, content string")
    got = ensemble.rerank(df, 3).orderBy("final_rank").collect()
    assert [(r.ensemble_rank, r.rerank_score) for r in got] == [(2, 1.0), (3, 1.0), (4, 0.5)]
    longest = ensemble.pair_scorer(lambda qs, cs: [len(c) for c in cs])
    assert [r.ensemble_rank for r in ensemble.rerank(df, 2, scorer=longest).orderBy("final_rank").collect()] == [2, 3]


def hits(spark):
    df = spark.createDataFrame([
        (1, 2, "second\nbody", "b.docx", "v2", 0.25), (1, 1, None, "a.docx", "v1", 0.00012), (2, 1, "solo", None, None, None)],
        "query_id int, rank int, content string, source string, vector_id string, retrieval_score double")
    return with_metadata(df).withColumn("modality", F.lit("text")).withColumn("rerank_score", F.lit(None).cast("double"))


def test_context_styles(spark):
    def of(style):
        return {r.query_id: r.context for r in context.build_context(hits(spark), style).collect()}

    assert of("numbered") == {1: "[Context 1]\n\n\n[Context 2]\nsecond\nbody", 2: "[Context 1]\nsolo"}
    assert of("source") == {1: "[Source: a.docx]\n\n\n[Source: b.docx]\nsecond\nbody", 2: "[Source: Unknown]\nsolo"}
    assert of("index")[1].split("\n")[0] == (
        "[1] chunk_id=v1 | modality=text | doc_id=None | source=N/A | score=0.00012 | rerank=None")
    assert of("index")[2].startswith("[1] chunk_id=N/A | modality=text | doc_id=None | source=N/A | score=None | rerank=None\n")
    with pytest.raises(ValueError):
        of("other")


def test_contexts_survive_packing(spark):
    rows = [(1, i, f"text {i} | with --- marks\n---", f"s{i}") for i in (1, 2, 3)]
    df = spark.createDataFrame(rows, "query_id int, rank int, content string, source string")
    got = context.unpack_contexts(context.pack_contexts(df)).collect()[0]
    assert got.contexts == [r[2] for r in rows] and got.source_list == ["s1", "s2", "s3"]


def test_sources_once_in_rank_order(spark):
    df = spark.createDataFrame([(1, 1, "b"), (1, 2, "a"), (1, 3, "b")], "query_id int, rank int, source string")
    assert context.sources_used(df).collect()[0].sources == "b | a"


def test_prompts(spark):
    df = spark.createDataFrame([("Why?", "ctx")], "q string, c string")
    for style, order in (("context_first", "ctx Why?"), ("question_first", "Why? ctx"), ("cited", "ctx Why?")):
        text = df.select(context.rag_prompt(style, F.col("q"), F.col("c")).alias("p")).collect()[0].p
        first, second = order.split()
        assert text.index(first) < text.index(second)
    with pytest.raises(ValueError):
        context.rag_prompt("odd", F.col("q"), F.col("c"))


def test_answer(spark):
    rows = [("who likes tea", "Ann likes coffee. Bo likes hot tea! Nobody else."), ("zebra", "No match here."), ("x", "")]
    df = spark.createDataFrame(rows, "question string, context string")
    got = [r.prediction for r in context.answer(df).collect()]
    assert got == ["Bo likes hot tea!", V.FALLBACK_EVAL, V.FALLBACK_EVAL]
    shout = context.answer(df.withColumn("prompt", F.col("question")), completer=lambda ps: [p.upper() for p in ps])
    assert [r.prediction for r in shout.collect()] == ["WHO LIKES TEA", "ZEBRA", "X"]


def test_render(spark):
    good = {"summary": "A chart.", "key_text": [f"k{i}" for i in range(12)], "warnings": [], "entities": [{"name": "n", "role": "r"}]}
    rows = [("image_vlm", json.dumps(good)), ("image_vlm", "{not json"), ("image_vlm", None), ("text", json.dumps(good)),
            (None, "x" * 1000)]
    df = with_metadata(spark.createDataFrame([(i, m, c) for i, (m, c) in enumerate(rows)], "n int, modality string, content string"))
    df = df.withColumn("retrieval_score", F.lit(0.5))
    got = [r.v for r in df.select("n", context.render_chunk().alias("v")).orderBy("n").collect()]
    head = "chunk_id=N/A | modality=image_vlm | doc_id=N/A | score=0.5\n"
    assert got[0] == head + "summary: A chart.\nkey_text: " + "; ".join(f"k{i}" for i in range(10)) + "\nwarnings: (none)"
    assert got[1] == head + "{not json" and got[2] == head
    assert got[3].split("\n", 1)[1] == json.dumps(good)
    assert got[4] == "chunk_id=N/A | modality=unknown | doc_id=N/A | score=0.5\n" + "x" * 900 + "…"
