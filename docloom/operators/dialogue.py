"""Conversation threads: ordered blocks, running history, last message; padded token ids."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom import fixed_values as V
from docloom.functions import text as tx
from docloom.operators.numbering import integer_bucket, ranged_positions, row_positions
from docloom.session import written

FREQUENT = 10_000  # word ids below this travel with the tasks


def thread_positions(df: DataFrame, thread: str = "conv_id", turn: str = "turn",
                     bucket: Sequence[Column] | None = None) -> DataFrame:
    """0-based place of each message in its thread.

    Turns that are clock ticks rather than small numbers need an ``even_bucket``.
    """
    return row_positions(df, [thread], [turn], bucket or integer_bucket(turn), "place")


def _in_blocks(placed: DataFrame, block: int) -> DataFrame:
    return placed.withColumn("block", F.floor(F.col("place") / block).cast("int"))


def _ordered_messages() -> Column:
    message = F.struct(F.col("place"), F.col("role"), F.col("text").alias("content"))
    return F.transform(F.array_sort(F.collect_list(message)),
                       lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))


def threads(df: DataFrame, thread: str = "conv_id", turn: str = "turn",
            bucket: Sequence[Column] | None = None) -> DataFrame:
    """Chat rows: all messages of a thread in order, one row per thread, whatever its length."""
    return thread_positions(df, thread, turn, bucket).groupBy(thread).agg(_ordered_messages().alias("messages"))


def thread_blocks(df: DataFrame, block: int, thread: str = "conv_id", turn: str = "turn",
                  bucket: Sequence[Column] | None = None) -> DataFrame:
    """The messages of a thread in rows of at most ``block``, for threads no executor could hold in one array."""
    placed = _in_blocks(thread_positions(df, thread, turn, bucket), block)
    return placed.groupBy(thread, "block").agg(_ordered_messages().alias("messages"))


def running_history(df: DataFrame, thread: str = "conv_id", turn: str = "turn",
                    bucket: Sequence[Column] | None = None) -> DataFrame:
    """For each turn all messages so far and their count. A thread of n turns holds about n * n / 2 messages."""
    so_far = Window.partitionBy(thread).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return thread_positions(df, thread, turn, bucket).select(
        thread, turn, "role", "text", (F.col("place") + 1).alias("n_messages"),
        F.collect_list(F.struct("role", F.col("text").alias("content"))).over(so_far).alias("history"))


def block_history(df: DataFrame, block: int, thread: str = "conv_id", turn: str = "turn",
                  bucket: Sequence[Column] | None = None) -> DataFrame:
    """For each turn the messages so far of its own block, and the count of all so far.

    The messages before them are the complete blocks ``0 .. block-1`` of
    :func:`thread_blocks`, so a thread of n turns costs n x block messages.
    """
    placed = _in_blocks(thread_positions(df, thread, turn, bucket), block)
    so_far = Window.partitionBy(thread, "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return placed.select(
        thread, turn, "role", "text", "block", (F.col("place") + 1).alias("n_messages"),
        F.collect_list(F.struct("role", F.col("text").alias("content"))).over(so_far).alias("history"))


def transcript(messages: str = "history"):
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")


def last_message(df: DataFrame, thread: str = "conv_id", turn: str = "turn") -> DataFrame:
    """The final message per thread; of several with the last turn the one whose other columns are greatest."""
    rest = [c for c in df.columns if c not in (thread, turn)]
    best = df.groupBy(thread).agg(F.max(F.struct(turn, *rest)).alias("_last"))
    return best.select(thread, "_last.*").select(*df.columns)


def sections(requirements: DataFrame, names: Sequence[str]) -> DataFrame:
    """Each requirement with every section name and its place in the list."""
    listed = F.posexplode(F.array(*[F.lit(n) for n in names])).alias("section_order", "section")
    return requirements.select("*", listed)


def vocabulary(df: DataFrame, text: str = "text", reserved: int = 2) -> DataFrame:
    """Word ids by falling count, then word; ids below ``reserved`` stay free for padding and unknown."""
    counts = df.select(F.explode(tx.tokens(F.col(text))).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n"))
    placed = ranged_positions(counts, [], [F.desc("n"), "word"], "_p")
    return placed.select("word", "n", (F.col("_p") + reserved).alias("word_id"))


def fixed_sequences(df: DataFrame, vocab: DataFrame, key: str = "doc_id", text: str = "text",
                    max_len: int = V.MAX_SEQUENCE) -> DataFrame:
    """Token ids cut or padded with 0 to ``max_len``, with their attention mask; unknown words read 1. ``key`` is unique.

    The most frequent words, a fixed number of them, travel with the tasks and are looked up in their row. Only words
    that this leaves open leave it, for a shuffled lookup; they are rare, so no word is hot.
    """
    known = vocab.where(F.col("word_id") < FREQUENT).select("word", "word_id").toArrow()
    shipped = df.sparkSession.sparkContext.broadcast((known.column("word").combine_chunks(), known.column("word_id").combine_chunks()))
    kind = df.schema[key].dataType.simpleString()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, ids = shipped.value
        for batch in batches:
            column = batch.column(1)
            flat, ends = column.flatten(), np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy())
            places = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            found = ids.take(pc.index_in(flat, value_set=words.cast(flat.type)))
            away = np.flatnonzero(pc.is_null(found).to_numpy(zero_copy_only=False))
            row = np.searchsorted(ends, away, "right")
            at = away - np.concatenate([[0], ends])[row]
            cut = pa.array(np.searchsorted(row, np.arange(len(ends) + 1)).astype(np.int32))
            open_ = pa.StructArray.from_arrays([pa.array(at.astype(np.int32)), flat.take(pa.array(away))], ["at", "word"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(places, pc.fill_null(found, 0)), pa.ListArray.from_arrays(cut, open_)], [key, "ids", "open"])

    head = F.slice(tx.tokens(F.col(text)), 1, max_len)
    near = written(df.select(key, head.alias("words")).mapInArrow(look, f"{key} {kind}, ids array<long>, open array<struct<at:int,word:string>>"), "sequences")
    rare = vocab.where(F.col("word_id") >= FREQUENT).select("word", F.col("word_id").alias("_far"))
    far = near.select(key, F.inline("open")).join(rare, "word", "left").groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("at", F.coalesce("_far", F.lit(1)).alias("id")))).alias("far"))
    filled = F.transform("ids", lambda x, i: F.when(x == 0, F.col("far")[i]).otherwise(x))
    pad = F.lit(max_len) - F.size("ids")
    return near.join(far, key, "left").select(key, F.when(F.size("open") > 0, filled).otherwise(F.col("ids")).alias("ids")).select(
        key,
        F.concat("ids", F.array_repeat(F.lit(0).cast("long"), pad)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), F.size("ids")), F.array_repeat(F.lit(0), pad)).alias("attention_mask"),
    )
