"""The stateful loops as streams: thread memory, incoming questions, incremental ingest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docloom.operators.collection import write_delta
from docloom.streaming import memory


def start_thread_memory(messages: DataFrame, out: str, checkpoint: str, **options) -> StreamingQuery:
    """Keep the memory of every thread (see :func:`memory.thread_memory` for the options) and log what it takes in.

    Each batch of the log is written under its own number, so a replay repeats it exactly; :func:`remembered` reads it.
    """
    named = {k: v for k, v in options.items() if k in ("thread", "turn")}
    with memory.keyed_state(messages.sparkSession):
        return _each_batch(memory.thread_memory(messages, **options), lambda df, n: write_delta(memory.by_turn(df, **named), out, n), checkpoint, "append")


def remembered(spark: SparkSession, out: str, thread: str = "conv_id") -> DataFrame:
    """The stored messages of every thread that has not expired: thread, place, turn, role, text."""
    return memory.stored_messages(spark.read.parquet(f"{out}/delta"), thread).drop("run_no", "batch_no")


def asked_once(questions: DataFrame, key: str = "query_id", event_time: str | None = None, within: str = "1 hour") -> DataFrame:
    """Questions without those that arrive again ``within`` a time; of equal keys the first to arrive counts.

    Time is that of ``event_time``, or of arrival. State is dropped once the watermark has passed it.
    """
    moment = event_time or "_arrived"
    timed = questions if event_time else questions.withColumn("_arrived", F.current_timestamp())
    once = timed.withWatermark(moment, within).dropDuplicatesWithinWatermark([key])
    return once if event_time else once.drop("_arrived")


def answer_stream(questions: DataFrame, answer: Callable[[DataFrame], DataFrame], out: str,
                  checkpoint: str, **once) -> StreamingQuery:
    """Every arriving micro-batch of questions, each question once, through the batch flow ``answer``.

    ``once`` goes to :func:`asked_once`.
    """
    return _each_batch(asked_once(questions, **once), lambda df, n: write_delta(answer(df), out, n), checkpoint, "append")


def ingest_stream(rows: DataFrame, out: str, checkpoint: str, run: int = 0) -> StreamingQuery:
    """Incremental ingest: each batch lands under its number; stable ids resolve on read.

    A later full re-ingest takes a higher ``run``; its rows replace equal ids.
    """
    return _each_batch(rows, lambda df, n: write_delta(df, out, n, run), checkpoint, "append")


def _each_batch(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                mode: str) -> StreamingQuery:
    return (df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
