"""Linking of quotations: who answers whom, and what they wrote themselves.

A message is read line by line. Marks at the start of a line give its quote level; lines
of one level make a passage, and the line that announces a quotation goes with it. Passages
are cut into sentences, normalised and hashed, and joined to the sentences of what others
wrote themselves in the same conversation. The original of a sentence is the first message that holds it, so a
phrase that everyone uses costs one row, not a pair for each use.

A message answers the one that most of its outermost quotation comes from, or else the one before
it. Where a message answers an older one, a branch begins; reply order follows each branch to
its end before it turns to the next one.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import columns_of, saved
from docloom.operators.numbering import integer_bucket, row_positions

MARKS = re.compile(r"^[ \t]*((?:>[ \t]?)+)")
#: Lines that announce a quotation, if one follows.
ANNOUNCED = re.compile(r"^(?:on|am|le|el)\b.{0,200}(?:wrote|schrieb|a écrit|escribió)\b.{0,80}:\s*$|^-+ ?original message ?-+\s*$", re.IGNORECASE)
STRETCH = 4096  # positions of a conversation that are worked through in one task


def parse(text: str | None) -> tuple[str, list[tuple[int, str]]]:
    """What a message says itself, and its quoted passages with their levels, in order."""
    levels: list[tuple[int, str]] = []
    for line in (text or "").split("\n"):
        marks = MARKS.match(line)
        levels.append((marks[1].count(">"), line[marks.end():]) if marks else (0, line))
    own, quotes, last = [], [], 0
    for i, (level, line) in enumerate(levels):
        following = levels[i + 1][0] if i + 1 < len(levels) else 0
        if following > level and ANNOUNCED.match(line.strip()):
            last = -1
        elif level == 0:
            own.append(line)
            last = 0
        elif level == last:
            quotes[-1][1].append(line)
        else:
            quotes.append((level, [line]))
            last = level
    passages = [(level, "\n".join(lines)) for level, lines in quotes]
    return "\n".join(own).strip("\n") if quotes else (text or ""), [q for q in passages if q[1].strip()]


def _parse_all(text: pd.Series) -> pd.DataFrame:
    found = [parse(t) for t in text]
    return pd.DataFrame({"own": [own for own, _ in found],
                         "quotes": [[{"level": n, "passage": p} for n, p in quotes] for _, quotes in found]})


def sentence_hashes(text: Column) -> Column:
    """Distinct hashes of the sentences of a text; letter case, punctuation and line breaks make no difference."""
    plain = F.regexp_replace(text, r"\s+", " ")
    sentences = F.transform(F.split(plain, r"(?<=[.!?]) "), lambda s: F.trim(F.regexp_replace(F.lower(s), r"[^\p{L}\p{N}]+", " ")))
    return F.transform(F.array_distinct(F.filter(sentences, lambda s: s != "")), lambda s: F.xxhash64(s))


def _last_start(rows: DataFrame) -> DataFrame:
    """For each message the position of the last branch start up to it: inside stretches, then across them."""
    rows = rows.withColumn("stretch", F.floor(F.col("position") / STRETCH))
    inside = Window.partitionBy("conv_id", "stretch").orderBy("position")
    rows = rows.withColumn("own_start", F.last("start", ignorenulls=True).over(inside))
    ends = rows.groupBy("conv_id", "stretch").agg(F.max("start").alias("latest"))
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("conv_id", "stretch", F.max("latest").over(before).alias("earlier"))
    return rows.join(ends, ["conv_id", "stretch"]).withColumn("run", F.coalesce("own_start", "earlier")).drop("own_start", "earlier", "stretch")


def _branch_keys(runs: DataFrame) -> DataFrame:
    """Sort keys of branches: that of the branch it leaves, then where it leaves it (late ones first), then its start.

    One round for each depth of branching.
    """
    known = runs.where("parent IS NULL").select("conv_id", "run", F.expr("cast(array() as array<long>)").alias("key"))
    front, done = known, saved(known, "branches")
    while True:
        step = runs.join(front.select("conv_id", F.col("run").alias("from_run"), F.col("key").alias("above")), ["conv_id", "from_run"])
        front = saved(step.select("conv_id", "run", F.concat("above", F.array(-F.col("parent"), F.col("run"))).alias("key")), "branches")
        if not front.limit(1).count():
            return done
        done = done.union(front)


def thread(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Conversations in reply order without quotations.

    Returns one row per message: conv_id, turn, role, position (in order of turns), reply_order, parent_turn, linked (whether
    a quotation names the parent), n_quotes (passages), n_linked (sentences whose original was found), depth (deepest
    level) and text (what the message says itself).

    Turns that repeat are ordered by role and text. Rows without conversation or turn belong to none: they keep their text
    and have no order and no parent. A null text is empty. An empty table gives an empty result. Other columns are ignored.
    """
    rows = columns_of(messages, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    parsed = F.pandas_udf(_parse_all, "own string, quotes array<struct<level:int,passage:string>>")
    rows = rows.withColumn("p", parsed("text")).select("conv_id", "turn", "role", F.col("p.own").alias("own"), F.col("p.quotes").alias("quotes"))
    placed = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    order = ["turn", "role", "own", F.xxhash64("quotes")]
    placed = saved(row_positions(placed, ["conv_id"], order, integer_bucket("turn")), "messages")

    said = placed.select("conv_id", "position", F.explode(sentence_hashes(F.col("own"))).alias("sentence"))
    originals = said.groupBy("conv_id", "sentence").agg(F.min("position").alias("original"))
    quoted = placed.where("size(quotes) > 0").select("conv_id", "position", F.inline("quotes"))
    quoted = quoted.select("conv_id", "position", "level", F.explode(sentence_hashes(F.col("passage"))).alias("sentence")).distinct()
    found = quoted.join(originals, ["conv_id", "sentence"]).where("original < position")
    votes = found.groupBy("conv_id", "position", "level", "original").agg(F.count(F.lit(1)).alias("n"))
    outer = F.struct(-F.col("level"), F.col("n"), F.col("original"))
    parents = votes.groupBy("conv_id", "position").agg(F.max_by("original", outer).alias("quoted_parent"), F.sum("n").alias("n_linked"))

    linked = placed.join(parents, ["conv_id", "position"], "left")
    # A branch starts where the parent is not simply the message before.
    starts = F.when(F.col("position") == 0, 0).when(F.col("quoted_parent") < F.col("position") - 1, F.col("position"))
    linked = saved(_last_start(linked.withColumn("start", starts.cast("long"))), "linked")
    runs = linked.where("start IS NOT NULL").select("conv_id", "run", F.col("quoted_parent").alias("parent"))
    homes = linked.select("conv_id", F.col("position").alias("parent"), F.col("run").alias("from_run"))
    runs = saved(runs.join(homes, ["conv_id", "parent"], "left"), "runs")
    sizes = linked.groupBy("conv_id", "run").agg(F.count(F.lit(1)).alias("size"))
    keys = _branch_keys(runs).join(sizes, ["conv_id", "run"])
    # One short row for each branch, not for each message.
    earlier = Window.partitionBy("conv_id").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keys.select("conv_id", "run", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"))

    parent = F.coalesce("quoted_parent", F.when(F.col("position") > 0, F.col("position") - 1))
    out = linked.join(offsets, ["conv_id", "run"]).withColumn("parent", parent)
    turns = placed.select("conv_id", F.col("position").alias("parent"), F.col("turn").alias("parent_turn"))
    out = out.join(turns, ["conv_id", "parent"], "left")
    facts = [F.size("quotes").cast("long").alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
             F.coalesce(F.array_max(F.transform("quotes", lambda q: q["level"])), F.lit(0)).alias("depth"), F.col("own").alias("text")]
    out = out.select("conv_id", "turn", "role", "position", (F.col("offset") + F.col("position") - F.col("run")).alias("reply_order"),
                     "parent_turn", F.col("quoted_parent").isNotNull().alias("linked"), *facts)
    stray = rows.where("conv_id IS NULL OR turn IS NULL").withColumn("n_linked", F.lit(0))
    nothing = F.lit(None).cast("long")
    return out.union(stray.select("conv_id", "turn", "role", nothing, nothing, F.lit(None).cast(rows.schema["turn"].dataType), F.lit(False), *facts))
