"""Sources, sinks and streams over small files."""

import datetime
import json
import os
import subprocess
import sys

import pytest
from pyspark.serializers import CloudPickleSerializer
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom import fixed_values as V
from docloom.operators import collection
from docloom.plans import ingest, retrieval
from docloom.queries import stream_queries
from docloom.sinks import writers
from docloom.sources import documents, records
from docloom.streaming import jobs, memory


def test_documents_of_a_folder(spark, tmp_path):
    (tmp_path / "a.txt").write_text("first\nsecond", encoding="utf-8")
    (tmp_path / "b.csv").write_text('name,note\nAnn,"two\nlines"\nBo,\n', encoding="utf-8")
    (tmp_path / "c.png").write_bytes(b"x")
    got = sorted((r.source, r.content) for r in documents.read_documents(spark, str(tmp_path)).collect())
    assert got == [("a.txt", "first\nsecond"), ("b.csv", "name: Ann\nnote: two\nlines"), ("b.csv", "name: Bo\nnote: ")]
    only_text = documents.read_documents(spark, str(tmp_path), [".txt"])
    assert only_text.count() == 1


def test_no_documents_is_an_error(spark, tmp_path):
    (tmp_path / "c.png").write_bytes(b"x")
    with pytest.raises(ValueError, match="no documents"):
        documents.read_documents(spark, str(tmp_path))


def test_layouts_and_path_ids(spark, tmp_path):
    for doc in ("doc_a", "doc_b"):
        for folder, names in (("images", ["figure_001.png", "figure_002.jpeg", "notes.txt"]), ("tables", ["table_001.csv"])):
            (tmp_path / doc / folder).mkdir(parents=True)
            for n in names:
                (tmp_path / doc / folder / n).write_bytes(b"abc")
    images = documents.with_path_ids(documents.scan_layout(spark, str(tmp_path), V.LAYOUTS["images"]))
    assert sorted((r.doc_id, r.item_id, r.length) for r in images.collect()) == [
        (d, f, 3) for d in ("doc_a", "doc_b") for f in ("figure_001", "figure_002")]
    capped = documents.scan_layout(spark, str(tmp_path), V.LAYOUTS["tables"], cap=1).collect()
    with pytest.raises(ValueError, match="no files"):
        documents.scan_layout(spark, str(tmp_path), V.LAYOUTS["text"])
    assert len(capped) == 1 and capped[0].path.endswith("doc_a/tables/table_001.csv")


def test_html_blocks(spark):
    html = ("<html><head><title>T &amp; co</title><script>var a='<p>no</p>';</script><STYLE>p{}</STYLE></head>"
            "<body><!-- gone --><h1>Head</h1><p>One <b>bold</b>\nmove<br>next &lt;x&gt;<div> </div><li>item</body>")
    df = spark.createDataFrame([(1, html), (2, "")], "page_id long, html string")
    got = [(r.block_index, r.block) for r in documents.text_blocks(df).orderBy("block_index").collect()]
    assert got == list(enumerate(["T & co", "Head", "One bold move", "next <x>", "item"]))


def test_html_character_references_and_quoted_brackets(spark):
    html = '<p>a &middot; b &copy; &#8364; &#x41; &amp;lt; &nbsp;x</p><a title="y>z" href=x>link</a><p class=\'>\'>q</p>1 < 2 <i title="open>r</i>'
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert [r.block for r in documents.text_blocks(df).orderBy("block_index").collect()] == ["a · b © € A &lt;  x", "link", "q", "1 < 2 r"]


def test_nested_columns(spark, tmp_path):
    (tmp_path / "p.csv").write_text("id,vitals.hr,vitals.spo2,labs.wbc,note\nP1,118.0,88.0,18.5,x\n")
    flat = spark.read.csv(str(tmp_path), header=True, inferSchema=True)
    nested = documents.nest_columns(flat)
    assert nested.columns == ["id", "vitals", "labs", "note"]
    row = nested.collect()[0]
    assert row.vitals.hr == 118.0 and row.vitals.spo2 == 88.0 and row.labs.wbc == 18.5


def test_chat_rows(spark, tmp_path):
    rows = [{"messages": [{"role": r, "content": f"{r} ’s"} for r in ("system", "user", "assistant")]} for _ in range(3)]
    (tmp_path / "c.jsonl").write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows), encoding="utf-8")
    got = records.read_chat(spark, str(tmp_path)).collect()
    assert len(got) == 3 and [m.role for m in got[0].messages] == ["system", "user", "assistant"]
    assert got[0].messages[1].content == "user ’s"


def test_golden_questions(spark, tmp_path):
    (tmp_path / "g.csv").write_text('question,answer,grounding_reference\n"One, or two?",Two,D1 | Clause 1\nLast?,"a\nb",D2 | Clause 3\n')
    got = [(r.idx, r.question, r.answer) for r in records.read_golden(spark, str(tmp_path / "g.csv")).orderBy("idx").collect()]
    assert got == [(0, "One, or two?", "Two"), (1, "Last?", "a\nb")]
    (tmp_path / "bad.csv").write_text("question,reply\na,b\n")
    with pytest.raises(ValueError, match=r"\['answer', 'question'\]"):
        records.read_golden(spark, str(tmp_path / "bad.csv"))


def test_eval_rows_keep_their_line_breaks(spark, tmp_path):
    ctx = V.CONTEXT_JOINER.join(['say "x", then', " second \n\n part ", ""])
    df = spark.createDataFrame([(0, "q?", "g", ' "p"\n', 0.5, "a | b", ctx)], records.EVAL_SCHEMA)
    writers.write_eval(df, str(tmp_path / "e"))
    back = records.read_eval(spark, str(tmp_path / "e")).collect()
    assert [tuple(r) for r in back] == [tuple(r) for r in df.collect()]


TRICKY = ['plain', 'say ""x"", then', 'two\nlines', '\n', '""', 'a,b', ' lead and trail ', 'é\r\nü', '""\n""', 'x' * 70 + '\n' + 'y' * 70, "", 'end""']


@pytest.mark.parametrize("split", [97, 400, 100_000])
def test_one_file_is_read_by_many_tasks(spark, tmp_path, split):
    import duckdb

    file = tmp_path / "big.csv"
    lines = [f'{i},"{TRICKY[i % len(TRICKY)]}",{"" if i % 5 == 0 else i / 4},"{TRICKY[(i * 7 + 3) % len(TRICKY)]}"' for i in range(120)]
    file.write_bytes(("\ufeffid,one,number,two\n" + "\n\n".join(lines[:60]) + "\n" + "\n".join(lines[60:])).encode())
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("one", T.StringType()), T.StructField("number", T.DoubleType()), T.StructField("two", T.StringType())])
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        rows = records.read_eval(spark, str(file), schema)
        tasks = spark.read.option("lineSep", "\n").text(str(file)).rdd.getNumPartitions()
        got = sorted(map(tuple, rows.collect()))
        golden = tmp_path / "golden.csv"
        golden.write_bytes(file.read_bytes().replace(b"\xef\xbb\xbfid,one,number,two", b"id,question,number,answer"))
        placed = records.read_golden(spark, str(golden)).orderBy("idx").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert tasks >= min(8, file.stat().st_size // split)
    with duckdb.connect() as con:
        want = con.execute("SELECT id::BIGINT, one, number::DOUBLE, two FROM read_csv(?, header = true, auto_detect = false, delim = ',', quote = '\"', escape = '\"', "
                           "new_line = '\\n', allow_quoted_nulls = false, "
                           "columns = {'id': 'VARCHAR', 'one': 'VARCHAR', 'number': 'VARCHAR', 'two': 'VARCHAR'})", [str(file)]).fetchall()
    assert got == sorted(want)
    assert [(r.idx, r.id, r.question) for r in placed] == [(i, str(i), TRICKY[i % len(TRICKY)].replace('""', '"')) for i in range(120)]


def test_documents_of_many_headers_take_one_read(spark, tmp_path):
    for i in range(30):
        (tmp_path / f"f{i}.csv").write_text(f'k{i}," b,{i}"\r\n"v\n{i}",x,dropped\r\n\r\nshort\r\n' if i % 2 else f"only{i}\n")
    got = documents.read_documents(spark, str(tmp_path), [".csv"])
    assert sorted((r.source, r.content) for r in got.collect()) == sorted(
        (f"f{i}.csv", c) for i in range(1, 30, 2) for c in (f"k{i}: v\n{i}\nb,{i}: x", f"k{i}: short\nb,{i}: "))
    # One read of the records gives the rows, another the headers, however many there are.
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2


def test_empty_cells_differ_from_missing_ones(spark, tmp_path):
    rows = [(0, "", None, "p", None, None, ""), (1, None, "", "", 0.5, "", None)]
    writers.write_eval(spark.createDataFrame(rows, records.EVAL_SCHEMA), str(tmp_path / "e"))
    assert sorted(tuple(r) for r in records.read_eval(spark, str(tmp_path / "e")).collect()) == rows


def test_rows_of_files_with_other_headers_keep_their_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,age\nAnn,30\nBo,31\n")
    (tmp_path / "b.csv").write_text('city,zip,land\nBern,3000,"CH\nch"\n')
    (tmp_path / "c.csv").write_text("name,age\nCy,32\n")
    got = sorted((r.source, r.content) for r in documents.read_documents(spark, str(tmp_path)).collect())
    assert got == [("a.csv", "name: Ann\nage: 30"), ("a.csv", "name: Bo\nage: 31"), ("b.csv", "city: Bern\nzip: 3000\nland: CH\nch"), ("c.csv", "name: Cy\nage: 32")]


def test_a_second_export_leaves_other_tables(spark, tmp_path):
    def of(doc, *values):
        return spark.createDataFrame([(doc, 1, v) for v in values], "doc_id string, table_index int, v string")

    for frame in (of("d1", "a", "b"), of("d2", "c"), of("d1", "z")):
        index = writers.export_tables(frame, str(tmp_path)).collect()
    assert [(r.doc_id, r.rows, r.cols) for r in index] == [("d1", 1, 1)]
    for stored in (spark.read.parquet(f"{tmp_path}/sql"), spark.read.csv(f"{tmp_path}/csv", header=True)):
        assert sorted((r.doc_id, r.v) for r in stored.collect()) == [("d1", "z"), ("d2", "c")]
    assert [r.v for r in writers.table_view(spark, str(tmp_path), "d2", 1, "d2__table_001").collect()] == ["c"]


def test_union_csv(spark, tmp_path):
    a, b = spark.createDataFrame([(1, "x")], "z int, b string"), spark.createDataFrame([(2, "y")], "z int, a string")
    assert writers.union_csv_frame([a, b]).columns == ["a", "b", "z"]
    assert writers.union_csv_frame([a, b], "first_seen").columns == ["z", "b", "a"]
    assert writers.write_union_csv([a, b], str(tmp_path / "u"))
    assert not writers.write_union_csv([a.limit(0)], str(tmp_path / "none")) and not (tmp_path / "none").exists()


def test_text_dump(spark):
    df = spark.createDataFrame([(1, 2, "s2", 0.5, "two"), (1, 1, None, 0.25, None)],
                               "query_id int, rank int, source string, score double, content string")
    got = writers.candidate_dump(df.withColumn("rerank_score", F.lit(None).cast("double"))).collect()[0].dump
    assert got == ("\n\n[1] source=Unknown | faiss_distance=0.250000 | rerank=None\n" + "-" * 80
                   + "\n\n[2] source=s2 | faiss_distance=0.500000 | rerank=None\ntwo")


def test_runs_are_never_overwritten(spark, tmp_path):
    df = spark.createDataFrame([(1, "q_001")], "a int, q_idx string")
    out = writers.write_run(df, str(tmp_path), "r1", "result", ["q_idx"])
    assert spark.read.json(out).collect()[0].q_idx == "q_001"
    with pytest.raises(Exception, match="already exists"):
        writers.write_run(df, str(tmp_path), "r1", "result", ["q_idx"])


def test_artifacts_are_all_there_or_none(spark, tmp_path):
    rows = spark.createDataFrame([(q, n, f"{q} {n}\nsecond line") for q in range(3) for n in writers.ARTIFACTS], "query_id long, artifact string, body string").repartition(3)
    out = writers.write_artifacts(rows, str(tmp_path / "run_1"))
    got = {(r.q_idx, r.artifact): r.body for r in writers.read_artifacts(spark, out).collect()}
    assert got == {(f"q_{q}", n): f"{q} {n}\nsecond line" for q in range(3) for n in writers.ARTIFACTS}
    with pytest.raises(Exception, match="already exists"):
        writers.write_artifacts(rows.limit(1), out)
    assert len(writers.read_artifacts(spark, out).collect()) == 18
    broken = rows.withColumn("body", F.when((F.col("query_id") == 2) & (F.col("artifact") == "answer.txt"), F.raise_error(F.lit("lost"))).otherwise(F.col("body")))
    with pytest.raises(Exception, match="lost"):
        writers.write_artifacts(broken, str(tmp_path / "run_2"))
    assert not (tmp_path / "run_2").exists()


def test_exported_tables(spark, tmp_path):
    df = spark.createDataFrame([("my doc", 1, 5, "x"), ("my doc", 1, 6, "y"), ("my doc", 12, 7, "z")],
                               "doc_id string, table_index int, n int, s string")
    got = sorted(map(tuple, writers.export_tables(df, str(tmp_path)).collect()))
    assert got == [("my doc", 1, "my_doc__table_001", 2, 2), ("my doc", 12, "my_doc__table_012", 1, 2)]
    writers.table_view(spark, str(tmp_path), "my doc", 1, "my_doc__table_001")
    assert spark.sql("SELECT sum(n) AS s FROM my_doc__table_001").collect()[0].s == 11


def words_collection(spark, texts, tag):
    docs = spark.createDataFrame([(i, tag, t) for i, t in enumerate(texts)], "doc_id long, source string, text string")
    return retrieval.text_collection(docs, 100, 10)


def test_ingest_twice_adds_nothing_and_answers(spark, tmp_path):
    path = str(tmp_path / "c")
    texts = ["cats drink milk.", "dogs chase cars.", "birds sing songs."]
    rows = words_collection(spark, texts, "s")
    ingest.store(path, rows)
    ingest.update(path, rows, words_collection(spark, ["fish swim far."], "t"), run=1)
    stored = ingest.open_collection(spark, path)
    assert stored.count() == 4
    asked = spark.createDataFrame([(1, "who does drink milk"), (2, "fish swim")], "query_id long, question string")
    best = retrieval.ensemble_hits(asked, stored).where("ensemble_rank = 1").collect()
    assert {r.query_id: r.content for r in best} == {1: "cats drink milk.", 2: "fish swim far."}
    final = {r.query_id: r.context for r in retrieval.ensemble_context(asked, stored).collect()}
    assert final[1].startswith("[1] chunk_id=") and "| source=s | score=" in final[1] and "cats drink milk." in final[1]
    plain = retrieval.ensemble_context(asked, stored, use_reranker=False).collect()
    assert all("rerank=None" in r.context for r in plain)


def message_files(spark, folder):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"m{c}.{t}") for c in range(4) for t in range(6)]
    schema = "conv_id long, turn long, role string, text string"
    for part in range(3):  # each file holds two turns of every thread
        spark.createDataFrame([r for r in rows if r[1] // 2 == part], schema).coalesce(1).write.mode("append").json(folder)
    return rows, schema


MESSAGES = "conv_id long, turn long, role string, text string"


def test_thread_memory_over_several_triggers(spark, tmp_path):
    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "cp"))
    rows, schema = message_files(spark, folder)
    before = spark.conf.get(memory.PROVIDER, None)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)
        jobs.start_thread_memory(stream, out, check).awaitTermination()
        return sorted((r.conv_id, r.turn, r.role, r.text) for r in jobs.remembered(spark, out).collect())

    assert run() == sorted(rows)
    got = {r.conv_id: (r.n_messages, r.last_turn, r.last_text) for r in memory.summary(jobs.remembered(spark, out)).collect()}
    assert got == {c: (6, 5, f"m{c}.5") for c in range(4)} and spark.conf.get(memory.PROVIDER, None) == before
    # After a restart from the checkpoint, turns that were sent before are not stored again; new ones go on where the thread was.
    again = [(0, 3, "assistant", "sent twice"), (0, 6, "user", "m0.6"), (1, -1, "user", "late"), (None, 1, "user", "x"), (2, None, "user", "x")]
    spark.createDataFrame(again, MESSAGES).coalesce(1).write.mode("append").json(folder)
    assert run() == sorted([*rows, again[1], again[2]])
    places = {(r.conv_id, r.turn): r.place for r in jobs.remembered(spark, out).collect()}
    assert places[0, 6] == 6 and places[1, -1] == 6 and sorted(p for (c, _), p in places.items() if c == 3) == list(range(6))


def test_thread_memory_is_unpickled_without_the_package(tmp_path):
    body = CloudPickleSerializer().dumps(memory.ThreadMemory("conv_id", "turn", None, None))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    load = "import pickle, sys; assert pickle.load(sys.stdin.buffer).turn == 'turn'"
    subprocess.run([sys.executable, "-c", load], input=body, cwd=tmp_path, env=env, check=True)


def test_places_follow_turns_where_a_thread_comes_in_parts(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(c, t, "user", f"{c}:{t}") for t in reversed(range(40)) for c in range(5)]
    schema = "conv_id long, turn long, role string, text string"
    spark.createDataFrame(rows, schema).coalesce(1).write.json(folder)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        jobs.start_thread_memory(spark.readStream.schema(schema).json(folder), out, str(tmp_path / "cp")).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = jobs.remembered(spark, out).select("conv_id", "place", "turn").collect()
    assert sorted(map(tuple, got)) == [(c, t, t) for c in range(5) for t in range(40)]


def test_streams_read_a_file_and_a_folder_of_files(spark, tmp_path):
    turns = [(c, t, "user", f"{c}:{t}") for c in range(20) for t in range(6)]
    texts = [(d, "a", "x" * (100 * d)) for d in range(12)]
    seen = []
    for kind in ("file", "folder"):
        sf = str(tmp_path / kind)
        os.makedirs(sf)
        for name, rows, schema in (("conversations", turns, "conv_id long, turn long, role string, text string"),
                                   ("documents", texts, "doc_id long, source string, text string")):
            df = spark.createDataFrame(rows, schema)
            if kind == "file":
                df.toPandas().to_parquet(f"{sf}/{name}.parquet")
            else:
                df.repartition(3).write.parquet(f"{sf}/{name}.parquet")
        seen.append([sorted(map(tuple, of(spark, sf).collect())) for of in (stream_queries.stream_thread_memory, stream_queries.stream_thread_messages, stream_queries.stream_upsert)])
    assert seen[0] == seen[1] and [len(x) for x in seen[0]][:2] == [20, 120] and seen[0][2]


def test_a_silent_thread_expires(spark, tmp_path):
    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = MESSAGES + ", at timestamp"

    def send(*rows):
        spark.createDataFrame([(c, t, "user", f"{c}.{t}", datetime.datetime(2024, 1, 1, 0, m)) for c, t, m in rows], schema).coalesce(1).write.mode("append").json(folder)
        stream = spark.readStream.schema(schema).json(folder).withWatermark("at", "0 seconds")
        jobs.start_thread_memory(stream, out, check, idle=10 * 60_000, event_time="at").awaitTermination()
        return sorted((r.conv_id, r.place, r.turn) for r in jobs.remembered(spark, out).collect())

    assert send((1, 0, 0), (1, 1, 1), (2, 0, 1)) == [(1, 0, 0), (1, 1, 1), (2, 0, 0)]
    assert send((2, 1, 8)) == [(1, 0, 0), (1, 1, 1), (2, 0, 0), (2, 1, 1)]
    # Thread 1 has been silent for more than ten minutes, thread 2 has not.
    assert send((3, 0, 14)) == [(2, 0, 0), (2, 1, 1), (3, 0, 0)]
    # What comes later begins it anew.
    assert send((1, 2, 15)) == [(1, 0, 2), (2, 0, 0), (2, 1, 1), (3, 0, 0)]
    log = spark.read.parquet(f"{out}/delta").where("expired").collect()
    assert [(r.conv_id, r.place, r.turn) for r in log] == [(1, 2, 1)]


def test_a_question_sent_twice_is_answered_once(spark, tmp_path):
    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = "query_id long, question string, at timestamp"

    def send(*rows):
        spark.createDataFrame([(q, x, datetime.datetime(2024, 1, 1, h, 0)) for q, x, h in rows], schema).coalesce(1).write.mode("append").json(folder)
        stream = spark.readStream.schema(schema).json(folder)
        jobs.answer_stream(stream, lambda batch: batch.drop("at"), out, check, event_time="at", within="2 hours").awaitTermination()
        return sorted((r.query_id, r.question) for r in spark.read.parquet(f"{out}/delta").collect())

    assert send((1, "a", 0), (1, "a", 1), (2, "b", 1)) == [(1, "a"), (2, "b")]
    assert send((1, "a", 0), (3, "c", 1)) == [(1, "a"), (2, "b"), (3, "c")]
    arrived = jobs.asked_once(spark.readStream.schema(schema).json(folder))
    assert arrived.columns == ["query_id", "question", "at"]


def test_streamed_questions_equal_the_batch(spark, tmp_path):
    rows = words_collection(spark, ["cats drink milk.", "dogs chase cars.", "birds sing songs."], "s").cache()
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "query_id long, question string"
    asked = [(1, "milk"), (2, "songs birds"), (3, "cars")]
    for q in asked:
        spark.createDataFrame([q], schema).coalesce(1).write.mode("append").json(folder)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)

    def answer(batch):
        return retrieval.ensemble_hits(batch, rows).select("query_id", "chunk_id", "ensemble_rank")

    jobs.answer_stream(stream, answer, out, str(tmp_path / "cp")).awaitTermination()
    streamed = spark.read.parquet(f"{out}/delta").select("query_id", "chunk_id", "ensemble_rank").collect()
    batch = answer(spark.createDataFrame(asked, schema)).collect()
    assert sorted(map(tuple, streamed)) == sorted(map(tuple, batch)) and streamed
    rows.unpersist()


def test_scratch_follows_the_cluster_setting(spark, tmp_path):
    from types import SimpleNamespace

    from docloom.session import scratch_path, shared_dir

    def cluster(master, setting):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: setting),
                               sparkContext=SimpleNamespace(master=master, applicationId="app"))

    named = cluster("yarn", "hdfs://shared/folder/")
    assert scratch_path(named, "x").startswith("hdfs://shared/folder/x-") and scratch_path(named, "x") != scratch_path(named, "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(cluster("yarn", None))
    assert shared_dir(cluster("local[2]", None))
