import random

import pytest
from pyspark.sql import functions as F

from docloom.operators import numbering as nb


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    keys = list(range(0, 3000, 3))
    rng.shuffle(keys)
    # One group holds most rows; another is NULL.
    return [(k, rng.choice(["hot", "hot", "hot", "a", None])) for k in keys]


def expected_positions(rows):
    seen, out = {}, {}
    for k, g in sorted(rows):
        out[k] = seen.get(g, 0)
        seen[g] = out[k] + 1
    return out, seen


@pytest.mark.parametrize("width", [7, 100, 1_000_000])
def test_positions_match_a_full_sort(spark, rows, width):
    df = spark.createDataFrame(rows, "k long, g string").repartition(5)
    got = nb.row_positions(df, ["g"], ["k"], nb.integer_bucket("k", width), total="n").collect()
    want, sizes = expected_positions(rows)
    assert {r.k: r.position for r in got} == want
    assert all(r.n == sizes[r.g] for r in got)


@pytest.mark.parametrize("parts", ["1", "13"])
def test_ranged_positions_match_a_full_sort(spark, rows, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame(rows, "k long, g string").repartition(5)
        got = nb.ranged_positions(df, ["g"], ["k"], total="n").collect()
        down = nb.ranged_positions(df, ["g"], [F.desc("k")]).collect()
        empty = nb.ranged_positions(df.limit(0), [], ["k"], total="n")
        assert empty.count() == 0 and empty.columns == ["k", "g", "position", "n"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    want, sizes = expected_positions(rows)
    assert {r.k: r.position for r in got} == want and all(r.n == sizes[r.g] for r in got)
    assert {r.k: sizes[r.g] - 1 - r.position for r in down} == want


def test_ranged_positions_of_clustered_keys_stay_even(spark):
    # Nine tenths of the rows share one document, which sits between far-off ids.
    df = spark.range(20_000).select(F.when(F.col("id") % 10 == 0, F.col("id") * 10**12).otherwise(77).alias("doc"), F.col("id").alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = nb.ranged_positions(df, [], ["doc", "n"])
        path = placed.inputFiles()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r[0] for r in spark.read.parquet(*path).groupBy(F.input_file_name()).agg(F.count(F.lit(1))).select("count(1)").collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)
    got = [(r.doc, r.n) for r in placed.orderBy("position").collect()]
    assert got == sorted(got)


def test_global_index_of_a_huge_document(spark):
    # One document holds a million chunks; the other ids are far apart and partly negative.
    huge = spark.range(1_000_000).select(F.lit(5).cast("long").alias("doc_id"), F.col("id").alias("chunk_index"))
    far = spark.range(2_000).select(((F.col("id") - 1_000) * 10**13).alias("doc_id"), F.lit(0).cast("long").alias("chunk_index"))
    got = nb.with_global_index(huge.union(far).repartition(11))
    wrong = got.where(F.col("chunk_index_global") != F.when(F.col("doc_id") == 5, F.col("chunk_index") + 1_002).when(
        F.col("doc_id") <= 0, F.col("doc_id") / 10**13 + 1_001).otherwise(F.col("doc_id") / 10**13 + 1_001_001))
    assert wrong.count() == 0 and got.count() == 1_002_000


def test_sparse_keys_get_even_buckets(spark):
    rng = random.Random(4)
    keys = sorted({rng.randrange(-(2**62), 2**62) for _ in range(500)})
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(3)
    bucket = nb.even_bucket(df, "k", rows=20)
    assert df.select(*bucket).distinct().count() <= 26
    got = nb.row_positions(df, [], ["k"], bucket).collect()
    assert [r.k for r in sorted(got, key=lambda r: r.position)] == keys
    assert nb.row_positions(df.limit(0), [], ["k"], nb.even_bucket(df.limit(0), "k")).count() == 0


def test_global_positions(spark, rows):
    df = spark.createDataFrame(rows, "k long, g string").repartition(4)
    got = nb.row_positions(df, [], ["k"], nb.integer_bucket("k", 50)).collect()
    assert [r.k for r in sorted(got, key=lambda r: r.position)] == sorted(k for k, _ in rows)


def test_numbering_shuffles_the_rows_once(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 3).cast("string").alias("g"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = nb.row_positions(df, ["g"], ["k"], nb.integer_bucket("k", 10))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    side = plan[plan.index("SortMergeJoin"):].split("\n")
    left = "\n".join(side[: next(i for i, line in enumerate(side) if "HashAggregate" in line)])
    # The big side is exchanged for its window, and not again for the join.
    assert left.count("Exchange hashpartitioning") <= 3


@pytest.mark.parametrize("n,percent,kept", [(200, 1, 2), (10, 14, 1), (10, 16, 2), (1, 1, 0), (7, 100, 7)])
def test_head_percent(spark, n, percent, kept):
    got = nb.head_percent(spark.range(n).withColumnRenamed("id", "k"), percent, "k")
    assert sorted(r.k for r in got.collect()) == list(range(kept))


def test_batches_are_full_but_the_last(spark):
    got = nb.batches(spark.range(101), 2, "id", "7").collect()
    sizes = {}
    for r in got:
        sizes[r.batch] = sizes.get(r.batch, 0) + 1
    assert sorted(sizes) == list(range(51)) and sizes[50] == 1 and sum(sizes.values()) == 101
    other = {r.id: (r.batch, r.slot) for r in nb.batches(spark.range(101), 2, "id", "8").collect()}
    assert other != {r.id: (r.batch, r.slot) for r in got}


def test_keep_first_and_removed_cover_the_input(spark):
    df = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("fp"))
    kept = {r.id for r in nb.keep_first(df, ["fp"], "id").collect()}
    gone = {r.id for r in nb.removed_rows(df, ["fp"], "id").collect()}
    assert kept | gone == set(range(300)) and not kept & gone
    assert gone == set(range(3, 300, 3))


def test_numbers_past_999_keep_their_digits(spark):
    df = spark.range(1, 1002).select(F.lit("d").alias("d"), F.col("id").alias("k"))
    labels = {r.number: r.number_label for r in nb.number_within(df, ["d"], "k").collect()}
    assert labels[1] == "001" and labels[1001] == "1001"
