"""Small documents with the odd cases every operator has to take."""

import random

EXTRA = "body string, names string, start int, window string, draw double, place int, tree int, `class` int, spans string, position long"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 8))) for _ in range(n))


def odd_rows():
    """Nulls, empty, blank, long, repeated and tied rows, among some ordinary ones."""
    same = words(1, 60)
    rows = [
        (1, None, "en", "a"), (2, "", "en", None), (3, " \n\t ", None, "a"), (4, same, "en", "a"), (5, same, "en", "b"), (5, same, "en", "b"),
        (None, same, "en", "a"), (None, None, None, None), (6, words(2, 40_000), "en", ""), (7, "one", "de", "a"), (8, "ONE", "de", "a"),
        (9, "é😀 ▁ " + same + " z", "fr", "c"), (10, "x" * 5000, "en", "c"), (11, same.upper(), "en", "c"), (12, "a b a b a b a b a b a b", "en", "c"),
        (-3, words(3, 30), "en", "d"),
    ]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]


def frame(spark, rows, extra=True):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:  # names that the operators use inside
        df = df.selectExpr("*", *[f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in EXTRA.split(", ")])
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(rows):
    return {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
