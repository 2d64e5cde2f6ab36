"""Evaluation, measurement, dialogue and collection tables against plain Python."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom import fixed_values as V
from docloom.operators import collection, dialogue, evaluation, measure


@pytest.mark.parametrize("values", [
    [0.9411764705882353, 0.7272727272727272, 0.888888888888889, 0.68],
    [1.0], [2.0, 1.0], [0.0] * 500 + [1.0, 5.0, 9.0], np.random.default_rng(1).normal(size=2001).tolist(),
    [float(i % 7) for i in range(1000)]])
def test_describe_matches_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double").repartition(3)
    got = evaluation.describe(df, "v").collect()[0]
    assert got["count"] == len(values) and got.min == min(values) and got.max == max(values)
    assert abs(got.mean - statistics.fmean(values)) < 1e-9
    if len(values) > 1:
        assert abs(got.std - statistics.stdev(values)) < 1e-9
    for p in (25, 50, 75):
        assert abs(got[f"p{p}"] - np.percentile(values, p)) < 1e-12


def test_extreme_quantiles(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    got = {r.q: r.value for r in evaluation.exact_quantiles(df, "v", [0.0, 0.333, 1.0]).collect()}
    assert got[0.0] == 0.0 and got[1.0] == 100.0 and abs(got[0.333] - 33.3) < 1e-9


def test_narrow_brackets_stay_exact(spark, monkeypatch):
    monkeypatch.setattr(evaluation, "BAND_ROWS", 3)
    monkeypatch.setattr(evaluation, "BRACKET", 0.05)
    rng = random.Random(4)
    values = [float(rng.randint(0, 50)) for _ in range(300)] + [rng.random() for _ in range(200)] + [7.0] * 400
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    qs = [0.0, 0.01, 0.2, 0.5, 0.77, 0.999, 1.0]
    got = {r.q: r.value for r in evaluation.exact_quantiles(df, "v", qs).collect()}
    assert all(abs(got[q] - np.quantile(values, q)) < 1e-9 for q in qs)


def test_metrics_are_joined_left(spark):
    a = spark.createDataFrame([(0, "x"), (1, "y")], "idx int, p string")
    b = spark.createDataFrame([(1, 0.5)], "idx int, m double")
    assert sorted(map(tuple, evaluation.merge_metrics(a, b).collect())) == [(0, "x", None), (1, "y", 0.5)]


def test_grounding_and_precision(spark):
    hits = spark.createDataFrame(
        [(1, 1, "DOC-1_a"), (1, 2, "DOC-2"), (1, 3, "DOC-1_b"), (2, 1, "DOC-9"), (2, 2, "DOC-9")],
        "query_id int, rank int, source string")
    golden = spark.createDataFrame([(1, "DOC-1 | Clause 4"), (2, "DOC-3 | Clause 1")], "query_id int, grounding_reference string")
    ranked = evaluation.grounding_hits(hits, golden)
    got = {r.query_id: r.context_precision for r in evaluation.context_precision(ranked).collect()}
    assert abs(got[1] - (1 + 2 / 3) / 2) < 1e-12 and got[2] == 0.0


def test_rubric_gate(spark):
    rows = [("pass", s) for s in (8, 7, 9, 6)] + [("low", s) for s in (10, 10, 10, 5)] + [("mean", s) for s in (7, 7, 7, 7)]
    got = {r.k: r.passed for r in evaluation.rubric_gate(spark.createDataFrame(rows, "k string, score double".replace("double", "int")), "k").collect()}
    assert got == {"pass": True, "low": False, "mean": False}


def test_final_draft(spark):
    def text(s):
        return f"ok FINAL_SCORE: {s}"

    rows = [("first", 1, text(8)), ("first", 2, text(9)), ("second", 1, text(7)), ("second", 2, text(10)), ("second", 3, text(8)),
            ("never", 1, text(5)), ("never", 2, text(6)), ("never", 3, text(4)), ("late", 1, text(1)), ("late", 4, text(9))]
    df = spark.createDataFrame(rows, "req_id string, iteration int, evaluation string")
    got = {r.req_id: (r.iteration, r.passed) for r in evaluation.final_draft(df).collect()}
    assert got == {"first": (1, True), "second": (2, True), "never": (3, False), "late": (1, False)}


def test_cost_notes_in_order(spark):
    rows = [("chat", 1000, 500), ("chat", None, 500), ("chat", None, None), ("embeddings", 2000, None), ("vlm", 100, 100),
            ("audio", 1, 1), ("audio", None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n int, stage string, input_tokens int, output_tokens int")

    def of(rates):
        return [(r.cost_usd, r.note, r.rates_used) for r in measure.estimate_cost(df, rates).orderBy("n").collect()]

    full = of(V.UNIT_COSTS)
    assert [round(c, 9) if c is not None else None for c, _, _ in full] == [0.0015, 0.0005, None, 0.0002, 0.001, None, None]
    assert full[0][1] is None and full[0][2] == {"chat_cost_per_1k_input": 0.001, "chat_cost_per_1k_output": 0.001}
    assert full[3][2] == {"embed_cost_per_1k_input": 0.0001}
    assert full[2][1] == V.NOTE_NO_TOKENS and full[5][1] == "Unknown stage 'audio'." and full[6][1] == V.NOTE_NO_TOKENS
    bare = of({"chat": (None, None), "embeddings": (None, None)})
    assert bare[0] == (None, "Chat costs not configured.", None) and bare[3][1] == "Embedding costs not configured."
    assert bare[4][1] == "Unknown stage 'vlm'." and bare[2][1] == V.NOTE_NO_TOKENS


def test_latency_drops_warm_up(spark):
    rows = [("a", i, 100.0 if i < 2 else float(i)) for i in range(7)] + [("b", 5, 1.0)]
    df = spark.createDataFrame(rows, "m string, run int, ms double")
    got = {r.m: (r.avg_latency, r.runs) for r in measure.latency(df, "m", "run", "ms", warmup=2).collect()}
    assert got == {"a": (4.0, 5)}
    assert {r.m: r.runs for r in measure.latency(df, "m", "run", "ms").collect()} == {"a": 6}


def test_latency_counts_tied_runs(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 1, 7.0), ("b", 1, 1.0), (None, 1, 2.0), (None, 2, 4.0)], "m string, run int, ms double")
    assert {r.m: (r.avg_latency, r.runs) for r in measure.latency(df, "m", "run", "ms").collect()} == {"a": (7.0, 1), None: (4.0, 1)}


def test_pair_and_improvement(spark):
    df = spark.createDataFrame([("x", "base", 200.0), ("x", "int8", 150.0), ("y", "base", 0.0)], "k string, m string, v double")
    both = measure.pair(df, ["k"], "m", "v", "base", "int8")
    got = {r.k: r.p for r in both.select("k", measure.improvement(F.col("base"), F.col("variant")).alias("p")).collect()}
    assert got == {"x": 25.0, "y": None}


def test_conditional_totals(spark):
    df = spark.createDataFrame([(124_000_000 - 1_200_000, False), (1_200_000, True)], "n long, t boolean")
    assert tuple(measure.conditional_totals(df, F.col("n"), F.col("t")).collect()[0]) == (124_000_000, 1_200_000, 0.97)


def test_models_and_sections_keep_every_row(spark):
    qs = spark.range(5).withColumnRenamed("id", "q")
    assert measure.model_questions(qs, ["m1", "m2"]).count() == 10
    got = [(r.section_order, r.section) for r in dialogue.sections(qs.limit(1), ["A", "B"]).collect()]
    assert sorted(got) == [(0, "A"), (1, "B")]


def threads():
    rng = random.Random(8)
    sizes = {1: 23, 2: 1, 3: 8}
    rows = [(c, t * 3, rng.choice(["user", "assistant"]), f"m{c}-{t}") for c, n in sizes.items() for t in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [4, 1000])
def test_history_blocks_rebuild_every_prefix(spark, block):
    rows = threads()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    blocks = {(r.conv_id, r.block): [(m.role, m.content) for m in r.messages]
              for r in dialogue.thread_blocks(df, block).collect()}
    assert all(len(m) <= block for m in blocks.values())
    for r in dialogue.block_history(df, block).collect():
        before = [m for b in range(r.block) for m in blocks[r.conv_id, b]]
        whole = before + [(m.role, m.content) for m in r.history]
        want = [(role, text) for c, t, role, text in sorted(rows) if c == r.conv_id and t <= r.turn]
        assert whole == want and r.n_messages == len(want)


def test_a_long_thread_is_complete(spark):
    rows = [(1, t, "user", f"m{t}") for t in range(200)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    assert [m.content for m in dialogue.threads(df).collect()[0].messages] == [f"m{t}" for t in range(200)]
    got = {r.turn: [m.content for m in r.history] for r in dialogue.running_history(df).collect()}
    assert got == {t: [f"m{i}" for i in range(t + 1)] for t in range(200)}


def test_last_message_of_tied_turns(spark):
    df = spark.createDataFrame([(1, 2, "user", "b"), (1, 2, "user", "a"), (1, 1, "x", "z")], "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in dialogue.last_message(df).collect()] == [(1, 2, "user", "b")]


def test_last_message(spark):
    df = spark.createDataFrame(threads(), "conv_id long, turn long, role string, text string")
    assert {r.conv_id: r.text for r in dialogue.last_message(df).collect()} == {1: "m1-22", 2: "m2-0", 3: "m3-7"}


@pytest.mark.parametrize("frequent", [0, 3, 10_000])
def test_sequences(spark, monkeypatch, frequent):
    monkeypatch.setattr(dialogue, "FREQUENT", frequent)
    docs = spark.createDataFrame([(1, "b a b"), (2, ""), (3, None), (4, "a b c d e")], "doc_id long, text string")
    vocab = dialogue.vocabulary(docs)
    ids = {r.word: r.word_id for r in vocab.collect()}
    assert ids == {"b": 2, "a": 3, "c": 4, "d": 5, "e": 6}
    got = {r.doc_id: (r.input_ids, r.attention_mask) for r in dialogue.fixed_sequences(
        docs, vocab.where("word <> 'd'"), max_len=4).collect()}
    assert got == {1: ([2, 3, 2, 0], [1, 1, 1, 0]), 2: ([0] * 4, [0] * 4), 3: ([0] * 4, [0] * 4), 4: ([3, 2, 4, 1], [1] * 4)}


def test_upsert(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "1")], "id string, v string")
    new = spark.createDataFrame([("b", "2", 1), ("b", "3", 2), ("c", "1", 1), ("c", "1", 1)], "id string, v string, n int")
    merged = collection.upsert(old, new, "id", "n")
    assert sorted(map(tuple, merged.collect())) == [("a", "1"), ("b", "3"), ("c", "1")]
    again = collection.upsert(merged, new, "id", "n")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, merged.collect()))


def test_collection_of_base_and_batches(spark, tmp_path):
    path = str(tmp_path / "coll")
    with pytest.raises(ValueError):
        collection.read_collection(spark, path, "id", "n")

    def frame(*rows):
        return spark.createDataFrame(rows, "id string, v string, n int, kind string")

    collection.write_base(frame(("a", "0", -1, "x"), ("a", "1", 0, "x"), ("b", "1", 0, "y")), path, "id", "n", "kind")
    assert collection.read_collection(spark, path, "id", "n").count() == 2
    collection.write_delta(frame(("b", "2", 1, "y"), ("b", "3", 2, "y")), path, 0)
    collection.write_delta(frame(("b", "3", 2, "y"), ("c", "1", 0, "x")), path, 1)
    collection.write_delta(frame(("b", "3", 2, "y"), ("c", "1", 0, "x")), path, 1)  # a replayed batch
    collection.write_delta(frame(("c", "9", 0, "x"),), path, 0, run=1)
    got = sorted((r.id, r.v, r.kind) for r in collection.read_collection(spark, path, "id", "n").collect())
    assert got == [("a", "1", "x"), ("b", "3", "y"), ("c", "9", "x")]
    with pytest.raises(Exception, match="already exists"):
        collection.write_base(frame(("a", "1", 0, "x")), path, "id", "n", "kind")
