"""Secret scan: patterns, and sliding-window Shannon entropy over candidate strings.

Everything is a DataFrame expression. A pattern's matches and the texts between them have
lengths that add up to positions, so no function with offsets is needed. The entropy of
each window follows from the last one: only the counts of the symbol that leaves and of
the one that enters change, and with them two terms of the sum.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import columns_of, spans_text

# The base patterns of the result's contract. ``hex`` and ``access`` carry their
# least length; ``assign`` is checked afterwards, for a match that fails still ends where it ends.
ASSIGN = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
KINDS = ["assign", "access", "hex", "entropy"]

NO_SPANS = "cast(array() as array<struct<start:int,place:int,end:int,kind:string,value:string>>)"

#: Character classes: name, runs of its characters, window, least entropy in bits per character.
CLASSES = [
    ("hex", r"(?<![0-9A-Za-z+/_=-])[0-9a-fA-F]{16,}+(?![0-9A-Za-z+/_=-])", 16, 2.75),
    ("base64", r"(?<![0-9A-Za-z+/_=-])[0-9A-Za-z+/_=-]{20,}+", 20, 3.6),
]

#: Candidate strings that are no secrets however varied they are.
ALLOWED = [
    r"^[A-Za-z_=/+-]+$",  # words, paths and rules without a digit
    r"^[0-9_=/+-]+$",  # plain numbers, dates, card-like groups
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # UUIDs
    r"(?i)example|sample|placeholder|dummy|changeme|abcdefgh|01234567|x{6}",
    r"^[a-z]+(?:[-_/][a-z]+)*[-_/]?[0-9]{1,4}$",  # slugs with a number
]


def _matches(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """(start, place, end, kind, value) of every match, leftmost first, in code points.

    The places between matches are cut out with the same pattern; lengths add up to positions.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    place = KINDS.index(kind)
    state = F.struct(F.lit(0).alias("at"), F.expr(NO_SPANS).alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + pair["gap"]
        end = start + F.length(pair["match"])
        one = F.struct(start.alias("start"), F.lit(place).alias("place"), end.alias("end"), F.lit(kind).alias("kind"), pair["match"].alias("value"))
        out = F.concat(acc["out"], F.array(one))
        if keep is not None:
            out = F.when(keep(pair["match"]), out).otherwise(acc["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    pairs = F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda m, g: F.struct(m.alias("match"), g.alias("gap")))
    return F.when(F.size(found) > 0, F.aggregate(pairs, state, step, lambda acc: acc["out"])).otherwise(
        F.expr(NO_SPANS))


def _term(n: Column) -> Column:
    return F.when(n > 0, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))


def _count(window: Column, symbol: Column) -> Column:
    return F.length(window) - F.length(F.replace(window, symbol, F.lit("")))


def window_entropies(value: Column, width: int) -> Column:
    """Entropy in bits per character of every window of ``width`` characters of a short ASCII string.

    With S the sum of n log n over the symbols of a window, entropy is log width - S / width.
    S is summed once for the first window. After that the leaving symbol, with n
    occurrences left, moves S by f(n) - f(n + 1), the entering one by f(n + 1) - f(n).
    """
    first = F.substring(value, 1, width)
    begin = F.aggregate(F.array_distinct(F.split(first, "")), F.lit(0.0), lambda acc, c: acc + _term(_count(first, c)))
    start = F.struct(begin.alias("s"), F.array(begin).alias("all"))

    def step(acc: Column, i: Column) -> Column:
        # Window i covers characters i + 1 to i + width; the core is what it shares with the last one.
        core = F.substring(value, i + 1, F.lit(width - 1))
        leaves, enters = F.substring(value, i, F.lit(1)), F.substring(value, i + width, F.lit(1))
        n_out, n_in = _count(core, leaves), _count(core, enters)
        s = acc["s"] + _term(n_out) - _term(n_out + 1) + _term(n_in + 1) - _term(n_in)
        return F.struct(s.alias("s"), F.concat(acc["all"], F.array(s)).alias("all"))

    def entropy(s: Column) -> Column:
        return F.lit(math.log2(width)) - s / width

    no_steps, no_windows = F.expr("cast(array() as array<int>)"), F.expr("cast(array() as array<double>)")
    steps = F.when(F.length(value) > width, F.sequence(F.lit(1), F.length(value) - width)).otherwise(no_steps)
    sums = F.aggregate(steps, start, step, lambda acc: acc["all"])
    return F.when(F.length(value) >= width, F.transform(sums, entropy)).otherwise(no_windows)


#: Windows that are taken in one go; longer candidates are cut into overlapping pieces, so that work stays linear.
PIECE = 256


def _dense_stretches(m: Column, width: int, least: float) -> Column:
    """The stretches of one candidate that its windows over the threshold cover, as spans."""

    def span(start: Column, end: Column) -> Column:
        return F.struct(start.alias("start"), F.lit(KINDS.index("entropy")).alias("place"), end.alias("end"),
                        F.lit("entropy").alias("kind"), F.lit("").alias("value"))

    def widen(acc: Column, at: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        start, end = m["start"] + at, m["start"] + at + width
        longer = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(span(last["start"], end)))
        return F.when((F.size(acc) > 0) & (last["end"] >= start), longer).otherwise(F.concat(acc, F.array(span(start, end))))

    def varied(piece: Column, k: Column) -> Column:
        starts = F.transform(window_entropies(piece, width), lambda h, i: F.when(h >= least, i + k * PIECE).otherwise(F.lit(-1)))
        return F.filter(starts, lambda i: i >= 0)

    pieces = F.regexp_extract_all(m["value"], F.lit(f"(?=(.{{1,{PIECE + width - 1}}})).{{1,{PIECE}}}"), F.lit(1))
    return F.aggregate(F.flatten(F.transform(pieces, varied)), F.expr(NO_SPANS), widen)


def _allowed(value: Column) -> Column:
    out = F.lit(False)
    for pattern in ALLOWED:
        out = out | value.rlike(pattern)
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets in every text: doc_id, text, base (pattern spans), found (all spans), each (start, place, end, kind, value).

    Base spans are the leftmost non-overlapping matches of each pattern. The entropy scan adds
    stretches of candidate strings whose windows exceed the class's threshold, unless the
    allow list names the string or a base span already covers the stretch. Positions are code points.

    A null or empty text has no spans. Null and repeated ids keep their rows; ties in start go by
    kind as listed. An empty table gives an empty result. Other columns are ignored.
    """
    rows = columns_of(docs, doc_id=id_col, text=text_col)
    rows = rows.select("doc_id", "text", F.coalesce("text", F.lit("")).alias("body"))
    none = F.expr(NO_SPANS)

    # One quick look at the text decides whether a pattern has to be cut out of it.
    def when_there(pattern: str, kind: str, keep=None) -> Column:
        return F.when(F.col("body").rlike(pattern), _matches(F.col("body"), pattern, kind, keep)).otherwise(none)

    rows = rows.select(
        "doc_id", "text", "body",
        when_there(ASSIGN, "assign", lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= 6).alias("assign"),
        when_there(ACCESS, "access").alias("access"), when_there(HEX, "hex").alias("hex"),
        *[when_there(runs, "entropy", lambda m: ~_allowed(m)).alias(f"runs_{name}") for name, runs, _, _ in CLASSES])
    rows = rows.withColumn("base", F.array_sort(F.concat("assign", "access", "hex")))

    def stretches(name: str, width: int, least: float) -> Column:
        return F.flatten(F.transform(f"runs_{name}", lambda m: _dense_stretches(m, width, least)))

    dense = F.concat(*[stretches(name, width, least) for name, _, width, least in CLASSES])
    rows = rows.withColumn("dense", F.when(F.size("runs_hex") + F.size("runs_base64") > 0, dense).otherwise(none))
    added = F.filter("dense", lambda d: ~F.exists("base", lambda b: (b["start"] <= d["start"]) & (d["end"] <= b["end"])))
    return rows.select("doc_id", "text", "base", F.array_sort(F.concat("base", F.array_distinct(added))).alias("found"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """All columns, with every span of ``scan`` in the text replaced by a mark; overlapping spans become one.

    Rows are changed in place, so null ids, repeated rows and further columns come through as they are.
    """
    taken = [c for c in docs.columns]
    rows = docs.withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in taken]))
    found = scan(rows.select(F.col("_row").alias("doc_id"), F.col(f"`{text_col}`").alias("text")))

    def cut(acc: Column, s: Column) -> Column:
        keep = F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        fresh = F.struct(s["end"].alias("at"), F.concat(acc["out"], keep, F.lit(mark)).alias("out"))
        inside = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        return F.when(s["start"] >= acc["at"], fresh).otherwise(inside)

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate("found", start, cut, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    new = F.when(F.size("found") > 0, clean).otherwise(F.col("text"))
    return found.select(*[new.alias(c) if c == text_col else F.col("doc_id")[c].alias(c) for c in taken])


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of ``scan``: counts per base kind, a hash of the base spans, all spans as text."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in KINDS[:3]], F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
                        spans_text(F.col("found")).alias("spans"))
