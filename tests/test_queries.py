"""Every registered query against its SQL, and the shape of its plan."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect
from docloom.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, con, sf, name):
    ok, note = compare(spark, con, name, QUERIES[name], ORACLES.get(name), sf)
    assert ok, note


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 40 and "prediction" in df.columns


SMOKE = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print(len(entry.queries()["chunk_recursive"](spark, sys.argv[2]).collect()))
"""


def test_workers_find_the_package_from_any_folder(sf, tmp_path):
    root = os.path.dirname(os.path.abspath(entry.__file__))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SMOKE, root, sf], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout.split()[-1]) > 0


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [n for n in sorted(QUERIES) if not n.startswith(("sink_", "stream_"))]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_product(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["knn_l2", "knn_collection", "ensemble_topk", "rerank_topk", "latency_average"])
def test_top_k_is_cut_before_the_shuffle(spark, sf, name):
    assert "WindowGroupLimit" in plan(QUERIES[name](spark, sf))


def test_scan_reads_only_needed_columns(spark, sf):
    text = plan(QUERIES["model_summary"](spark, sf))
    assert "props" not in text
