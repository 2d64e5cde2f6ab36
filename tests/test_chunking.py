import random

import pytest
from pyspark.sql import functions as F

from docloom import fixed_values as V
from docloom.operators import chunking as ck
from docloom.operators.numbering import integer_bucket


def random_text(rng, n):
    words = ["a", "été", "straße", "word", "x" * 30, "fin. ", "\n", "\n\n", " ", "  ", "𝔘nicode", "."]
    return "".join(rng.choice(words) + rng.choice(["", " "]) for _ in range(n))


@pytest.mark.parametrize("size,overlap", [(10, 0), (10, 9), (25, 5), (60, 20), (500, 50)])
def test_recursive_chunks_cover_the_text(size, overlap):
    rng = random.Random(size + overlap)
    texts = ["", "   ", "\n\n", "abc", "x" * 200, "a. b. c. " * 20] + [random_text(rng, k) for k in (1, 5, 40, 300)]
    for t in texts:
        got = list(ck.recursive_chunks(t, size, overlap, V.SEPARATORS))
        assert all(t[at:at + len(c)] == c and 0 < len(c) <= size and c == c.strip() for _, at, c in got)
        assert [i for i, _, _ in got] == list(range(len(got)))
        covered = set()
        for _, at, c in got:
            covered.update(range(at, at + len(c)))
        assert all(t[i].isspace() for i in range(len(t)) if i not in covered)


# Written out by hand; SQL checks the same rules on the given documents.
@pytest.mark.parametrize("text,size,overlap,want", [
    ("one two three four", 9, 0, ["one two", "three", "four"]),
    ("aa bb cc dd", 6, 3, ["aa bb", "bb cc", "cc dd"]),
    ("aa bb cc dd", 6, 2, ["aa bb", "cc dd"]),
    ("first part\n\nsecond part", 12, 0, ["first part", "second part"]),
    ("x" * 12, 5, 0, ["xxxxx", "xxxxx", "xx"]),
    ("x" * 12, 5, 2, ["xxxxx", "xxxxx", "xxxxx", "xxx"]),
    ("ab\n" + "y" * 7 + "\ncd", 5, 0, ["ab", "yyyy", "yyy", "cd"]),
])
def test_recursive_chunks_by_hand(text, size, overlap, want):
    assert [c for _, _, c in ck.recursive_chunks(text, size, overlap, V.SEPARATORS)] == want


def test_chunk_text_copies_metadata(spark):
    df = spark.createDataFrame([(1, "s1", "one two three four"), (2, "s2", None), (3, "s3", "")],
                               "doc_id long, source string, text string")
    got = ck.chunk_text(df, 9, 0).orderBy("chunk_index").collect()
    assert [(r.doc_id, r.source, r.content) for r in got] == [(1, "s1", "one two"), (1, "s1", "three"), (1, "s1", "four")]


def test_sql_chunker_equals_operator(spark):
    ck.register_chunker(spark, keep="doc_id BIGINT, source STRING")
    df = spark.createDataFrame([(1, "a. b\n\nc " * 30, "s"), (2, "x" * 99, None), (3, None, "t")], "doc_id long, text string, source string")
    df.repartition(3).createOrReplaceTempView("chunker_input")
    via_sql = spark.sql("SELECT * FROM chunk(TABLE(chunker_input), 20, 5)")
    direct = ck.chunk_text(df, 20, 5, keep=["doc_id", "source"])
    assert via_sql.columns == direct.columns and sorted(map(str, via_sql.collect())) == sorted(map(str, direct.collect()))
    assert "SinglePartition" not in via_sql._jdf.queryExecution().executedPlan().toString()
    for wrong, said in (("TABLE(SELECT doc_id FROM chunker_input), 20, 5", "lacks"), ("TABLE(chunker_input), 5, 5", "cannot share")):
        with pytest.raises(Exception, match=said):
            spark.sql(f"SELECT * FROM chunk({wrong})").collect()


@pytest.mark.parametrize("size,overlap", [(5, 0), (5, 4), (5, 2), (7, 6), (500, 50)])
def test_fixed_windows(spark, size, overlap):
    rng = random.Random(1)
    texts = ["", "a", "abcde", "abcdef", "é\n𝔘" * 9, random_text(rng, 200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in ck.chunk_fixed(df, size, overlap, keep=["doc_id"]).collect():
        got.setdefault(r.doc_id, []).append((r.chunk_index, r.start, r.content))
    for i, t in enumerate(texts):
        want, at, c = [], 0, 0
        while t:
            want.append((c, at, t[at:at + size]))
            if at + size >= len(t):
                break
            at, c = at + size - overlap, c + 1
        assert sorted(got.get(i, [])) == want


#: Rows of a table, and the (first, end) of its groups of 20 with 3 rows shared.
ROW_GROUPS = {
    0: [], 1: [(0, 1)], 19: [(0, 19)], 20: [(0, 20)], 21: [(0, 20), (17, 21)], 37: [(0, 20), (17, 37)],
    38: [(0, 20), (17, 37), (34, 38)], 55: [(0, 20), (17, 37), (34, 54), (51, 55)],
}


@pytest.mark.parametrize("n", sorted(ROW_GROUPS))
def test_row_groups(spark, n):
    df = spark.range(n).select(F.lit("t").alias("t"), F.col("id").alias("k"))
    got = ck.chunk_rows(df, ["t"], ["k"], integer_bucket("k", 16)).collect()
    want = [(i, a, b, row) for i, (a, b) in enumerate(ROW_GROUPS[n], 1) for row in range(a, b)]
    assert sorted((r.chunk_index_in_table, r.row_start, r.row_end_exclusive, r.row_number) for r in got) == want


@pytest.mark.parametrize("size,overlap", [(0, 0), (5, -1), (5, 5)])
def test_bad_sizes(size, overlap):
    with pytest.raises(ValueError):
        ck.check_sizes(size, overlap)


def test_csv_cells_are_quoted_and_nulls_empty(spark):
    df = spark.createDataFrame([("t", 0, 'say "hi", you', None)], "t string, k long, a string, b string")
    rows = ck.chunk_rows(df, ["t"], ["k"], integer_bucket("k"))
    body = ck.rows_to_text(rows, ["t"], ["a", "b"], "csv").collect()[0].body
    assert body == 'a,b\n"say ""hi"", you",'
    body = ck.rows_to_text(rows, ["t"], ["a", "b"], "markdown").collect()[0].body
    assert body.split("\n")[-1] == '| say "hi", you |  |'
    with pytest.raises(ValueError):
        ck.rows_to_text(rows, ["t"], ["a"], "html")


def test_columns_are_stripped(spark):
    assert ck.strip_columns(spark.createDataFrame([(1, 2)], " a long, `b ` long")).columns == ["a", "b"]
