"""Column functions against the plain-Python behaviour they have to equal."""

import base64
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from docloom import fixed_values as V
from docloom.functions import scoring
from docloom.functions import text as tx

TEXTS = ["", " ", "  a　", "Été  DÉJÀ\tvu\n\n\n\nnow\r\n", "x" * 300, "a_b-c.d", "é combining", "½ ² ٣ 中文字",
         "line\n\n\nthree", "\x1cfs\x85nel", "  ..//  ", "___", "naïve “quotes” … end"]


def run(spark, expr, values=TEXTS):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r.v for r in df.select("i", expr.alias("v")).orderBy("i").collect()]


def test_strip_and_normalize(spark):
    c = F.col("t")
    assert run(spark, tx.strip(c)) == [t.strip() for t in TEXTS]
    assert run(spark, tx.normalize(c)) == [re.sub(r"\s+", " ", t.lower().strip()) for t in TEXTS]


def test_tokens(spark):
    assert run(spark, tx.tokens(F.col("t"))) == [re.findall(r"\w+", t.lower()) for t in TEXTS]
    assert run(spark, tx.tokens(F.col("t")), [None]) == [[]]


def test_previews(spark):
    c = F.col("t")
    assert run(spark, tx.preview(c), ["one\ntwo", "x" * 219 + "\nyz", None]) == ["one two", "x" * 219 + " ", ""]
    assert run(spark, tx.ellipsis(c), ["short", "y" * 200, "y" * 201]) == ["short", "y" * 200, "y" * 200 + "..."]
    texts = ["  kept  ", "a\n\n\n\nb", "a\r\nb", "0123456789", "0123456789x", None]
    assert run(spark, tx.safe_preview(c, 10), texts) == ["kept", "a\n\nb", "a\nb", "0123456789", "0123456789…", ""]


def test_safe_name(spark):
    texts = ["plain-1.txt", "two words & more", "__x__", "ünï", "///", ""]
    assert run(spark, tx.safe_name(F.col("t")), texts) == ["plain-1.txt", "two_words_more", "x", "n", "untitled", "untitled"]


def test_paths(spark):
    paths = ["out/doc 1/tables/table_001.csv", "a/b.c/d.tar.gz", "x.PDF", "noext", "a/b/.hidden"]
    assert run(spark, tx.suffix(F.col("t")), paths) == [".csv", ".gz", ".pdf", "", ".hidden"]
    assert run(spark, tx.grandparent(F.col("t")), paths) == ["doc 1", "a", None, None, "a"]
    assert run(spark, tx.stem(F.col("t")), paths)[:3] == ["table_001", "d.tar", "x"]


def test_data_url(spark):
    raw = bytes(range(256)) * 3
    df = spark.createDataFrame([("a/p.JPG", bytearray(raw))], "path string, content binary")
    got = df.select(tx.data_url(F.col("path"), F.col("content"), V.IMAGE_MIME).alias("u")).collect()[0].u
    assert got == "data:image/jpeg;base64," + base64.b64encode(raw).decode()
    bad = spark.createDataFrame([("p.gif", bytearray(b"1"))], "path string, content binary")
    with pytest.raises(Exception, match="unsupported image type"):
        bad.select(tx.data_url(F.col("path"), F.col("content"), V.IMAGE_MIME)).collect()


def test_stable_id_reads_missing_parts_as_empty(spark):
    got = run(spark, tx.stable_id(F.lit(None), F.col("t"), F.lit(7)), ["x", None])
    assert got == [hashlib.sha256(f"::{t}::7".encode()).hexdigest()[:24] for t in ("x", "")]


def test_split_outside_parens(spark):
    got = run(spark, tx.split_outside_parens(F.col("t")), ["ventilation (AC, low), lines (a + b), drip", "one", "a,b,  c"])
    assert got == [["ventilation (AC, low)", "lines (a + b)", "drip"], ["one"], ["a", "b", "c"]]


def test_discount(spark):
    got = run(spark, tx.discount_text(F.col("t")), ["2000,10", " 80 , 12.5 ", "5", "1,2,3", "ten,5", "9.99,100"])
    assert got[0] == "Final price after 10.0% discount is 1800.00"
    assert got[1] == "Final price after 12.5% discount is 70.00"
    assert all(g.startswith("Invalid input. Use 'price,discount'.") for g in got[2:5])
    assert got[5] == "Final price after 100.0% discount is 0.00"
    assert got[2].endswith("Error: not enough values to unpack (expected 2, got 1)") and got[3].endswith("Error: too many values to unpack (expected 2)")
    assert got[4].endswith("Error: could not convert string to float: 'ten'")
    odd = run(spark, tx.discount_text(F.col("t")), ["1e30,10", "10d,5", "5,NaN", ",", ".5,50"])
    assert odd[0] == "Final price after 10.0% discount is 900000000000000000000000000000.00"
    assert odd[1].endswith("float: '10d'") and odd[2].endswith("float: 'NaN'") and odd[3].endswith("float: ''") and odd[4].endswith("0.25")


def test_scores_in_text(spark):
    from docloom.operators.evaluation import passed_by_text

    texts = ["FINAL_SCORE: 7", "FINAL_SCORE: 8", "FINAL_SCORE: 8.5", "x FINAL_SCORE: 10 y", "FINAL_SCORE: 80", "FINAL_SCORE:8", ""]
    assert run(spark, passed_by_text(F.col("t")), texts) == [False, True, True, True, True, False, False]
    df = spark.createDataFrame([("Relevance: 8\nclarity: 7.5\nFeasibility: high",)], "t string")
    row = df.select(*tx.rubric_scores(F.col("t"), V.RUBRIC_DIMENSIONS)).collect()[0]
    assert (row.relevance, row.clarity, row.completeness, row.feasibility) == (8.0, 7.5, None, None)


def test_template_and_echo(spark):
    expr = tx.fill_template("Hi {name}, {tone}!", {"name": F.col("t"), "tone": F.lit("calm")})
    assert run(spark, expr, ["Bo", None]) == ["Hi Bo, calm!", "Hi , calm!"]
    assert run(spark, tx.strip_echo(F.col("t"), F.lit("ask: ")), ["ask:  yes \n"]) == ["yes"]


def test_keyword_share(spark):
    keys = F.array(F.lit("verify"), F.lit("identity"), F.lit("know"))
    assert run(spark, tx.keyword_share(F.col("t"), keys), ["We VERIFY identity", "no", None]) == [2 / 3, 0.0, 0.0]


def naive_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            table[i][j] = table[i - 1][j - 1] + 1 if x == y else max(table[i - 1][j], table[i][j - 1])
    return table[-1][-1]


def test_lcs_against_the_table():
    import random

    rng = random.Random(2)
    for n, m in [(0, 0), (0, 5), (5, 0), (1, 1), (30, 40), (200, 150)]:
        a, b = [rng.choice("abcd") for _ in range(n)], [rng.choice("abcd") for _ in range(m)]
        assert scoring.common_subsequence(a, b) == naive_lcs(a, b)


@pytest.mark.parametrize("pred,ref,lcs,f1", [
    (17, 17, 16, 0.9411764705882353), (24, 20, 16, 0.7272727272727272), (12, 15, 12, 0.888888888888889), (30, 20, 17, 0.68)])
def test_rouge_of_known_counts(spark, pred, ref, lcs, f1):
    shared = [f"s{i}" for i in range(lcs)]
    p = " ".join(shared + [f"p{i}" for i in range(pred - lcs)])
    r = " ".join(shared + [f"r{i}" for i in range(ref - lcs)])
    df = spark.createDataFrame([(p, r)], "p string, r string")
    assert df.select(scoring.rouge_l(F.col("p"), F.col("r")).alias("v")).collect()[0].v == f1


def test_rouge_edges(spark):
    rows = [("same words", "Same, words!", 1.0), ("a", "b", 0.0), ("", "b", 0.0), ("a", None, 0.0), (None, None, 0.0)]
    df = spark.createDataFrame([(i, p, r) for i, (p, r, _) in enumerate(rows)], "i int, p string, r string")
    got = [x.v for x in df.select("i", scoring.rouge_l(F.col("p"), F.col("r")).alias("v")).orderBy("i").collect()]
    assert got == [w for _, _, w in rows]


def test_bleu_of_known_matches(spark):
    # 14 and 13 words whose clipped matches are 11/14, 8/13, 6/12 and 4/11.
    ref = "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13"
    hyp = "w1 w2 w3 w4 w5 w6 w7 x1 w9 w10 w11 x2 x3 w13"
    assert scoring.bleu_of(ref.split(), ref.split()) == 1.0
    counts = []
    for n in range(1, 5):
        grams = lambda t: [tuple(t[i:i + n]) for i in range(len(t) - n + 1)]
        have, want = grams(hyp.split()), grams(ref.split())
        counts.append((sum(min(have.count(g), want.count(g)) for g in set(have)), len(have)))
    assert counts == [(11, 14), (8, 13), (6, 12), (4, 11)]
    df = spark.createDataFrame([(hyp, ref), (None, ref), ("", "")], "h string, r string")
    got = [r.v for r in df.select(scoring.bleu4(F.col("h"), F.col("r")).alias("v")).collect()]
    assert abs(got[0] - 0.5445178846139404) < 1e-12 and got[1:] == [0.0, 0.0]
    short = scoring.bleu_of("w1 w2 w3 w4 w5".split(), ref.split())
    assert abs(short - 2.718281828459045 ** (1 - 13 / 5)) < 1e-12
