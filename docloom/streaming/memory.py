"""The memory of a thread as keyed state: its messages, their order, and an end when it falls silent."""

from __future__ import annotations

import datetime
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# The worker on the driver's side that prepares the state gets no shipped files, so the processor travels with its code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def millis(moment) -> int:
    return int(pd.Timestamp(moment).timestamp() * 1000) if isinstance(moment, (datetime.datetime, pd.Timestamp)) else int(moment)


class ThreadMemory(StatefulProcessor):
    """Stores each message of a thread once, in order of turns within a trigger, and forgets the thread after ``idle`` milliseconds.

    State: ``head`` (messages stored, last turn) and ``messages``, a list that grows by appending; it is read again only when
    a turn arrives that is not after the last one, to see whether it is known. So a trigger costs what is new in it.
    """

    def __init__(self, thread: str, turn: str, idle: int | None, event_time: str | None):
        self.thread, self.turn, self.idle, self.event_time = thread, turn, idle, event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", "n long, last long")
        self.messages = handle.getListState("messages", "turn long, role string, text string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        n, last = self.head.get() if self.head.exists() else (0, None)
        known, latest, news = None, None, False
        for part in rows:
            if self.event_time and len(part):
                newest = millis(part[self.event_time].max())
                latest = newest if latest is None else max(latest, newest)
            part = part.sort_values([self.turn, "role", "text"], kind="stable").drop_duplicates(self.turn)
            if last is not None and len(part) and part[self.turn].iloc[0] <= last:
                if known is None or news:
                    known = {row[0] for row in self.messages.get()}
                    news = False
                part = part[~part[self.turn].isin(known)]
            if not len(part):
                continue
            fresh = [(int(t), None if pd.isna(r) else r, None if pd.isna(x) else x) for t, r, x in zip(part[self.turn], part["role"], part["text"])]
            self.messages.appendList(fresh)
            news = True
            out = self._rows(key, len(fresh), place=range(n, n + len(fresh)), turn=[f[0] for f in fresh], role=[f[1] for f in fresh],
                             text=[f[2] for f in fresh], expired=False)
            n += len(fresh)
            last = max(fresh[-1][0], fresh[-1][0] if last is None else last)
            yield out
        self.head.update((n, last))
        if self.idle is not None:
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old)
            now = latest if self.event_time else timerValues.getCurrentProcessingTimeInMs()
            self.handle.registerTimer(now + self.idle)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        n, last = self.head.get()
        self.head.clear()
        self.messages.clear()
        yield self._rows(key, 1, place=[n], turn=[last], role=[None], text=[None], expired=True)

    def _rows(self, key, size: int, place, turn, role, text, expired: bool) -> pd.DataFrame:
        return pd.DataFrame({
            self.thread: [key[0]] * size, "place": pd.Series(list(place), dtype="int64"), self.turn: pd.Series(turn, dtype="int64"),
            "role": pd.Series(role, dtype=object), "text": pd.Series(text, dtype=object), "expired": [expired] * size})

    def close(self) -> None:
        pass


def thread_memory(messages: DataFrame, thread: str = "conv_id", turn: str = "turn", idle: int | None = None, event_time: str | None = None) -> DataFrame:
    """The log of what each thread's memory takes in: thread, place, turn, role, text, expired.

    A message is stored once, however often its turn arrives; a message without a thread or a turn has no place and is left out. With
    ``idle`` (milliseconds) a thread that has had no message for so long is forgotten: one row with ``expired`` and the number of
    messages it had as its place. A message after that begins the thread anew. Time is that of processing, or that of the column
    ``event_time``, which needs a watermark.
    """
    mode = "None" if idle is None else "EventTime" if event_time else "ProcessingTime"
    schema = T.StructType([messages.schema[thread], T.StructField("place", T.LongType()), T.StructField(turn, T.LongType()),
                           T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), T.StructField("expired", T.BooleanType())])
    given = messages.where(F.col(thread).isNotNull() & F.col(turn).isNotNull()).select(
        thread, F.col(turn).cast("long").alias(turn), "role", "text", *([event_time] if event_time else []))
    return given.groupBy(thread).transformWithStateInPandas(ThreadMemory(thread, turn, idle, event_time), schema, "Append", mode)


class keyed_state:
    """Streams started inside keep their state in RocksDB, which list state and timers need; the setting is put back after."""

    def __init__(self, spark: SparkSession):
        self.conf = spark.conf

    def __enter__(self):
        self.before = self.conf.get(PROVIDER, None)
        self.conf.set(PROVIDER, ROCKS)

    def __exit__(self, *problem):
        if self.before is None:
            self.conf.unset(PROVIDER)
        else:
            self.conf.set(PROVIDER, self.before)


def by_turn(log: DataFrame, thread: str = "conv_id", turn: str = "turn") -> DataFrame:
    """The log of one trigger with places in order of turns; its rows may reach a thread in several parts, in any order."""
    own = Window.partitionBy(thread, "expired")
    return log.withColumn("place", F.min("place").over(own) + F.row_number().over(own.orderBy(turn)) - 1)


def stored_messages(log: DataFrame, thread: str = "conv_id") -> DataFrame:
    """The messages that the threads remember: those of a log (with its ``batch_no``) after the thread last expired."""
    gone = log.where("expired").groupBy(F.col(thread).alias("_thread")).agg(F.max("batch_no").alias("_gone"))
    kept = log.where("NOT expired").join(gone, F.col(thread) == F.col("_thread"), "left")
    return kept.where(F.col("_gone").isNull() | (F.col("batch_no") > F.col("_gone"))).drop("_thread", "_gone", "expired")


def summary(messages: DataFrame, thread: str = "conv_id", turn: str = "turn") -> DataFrame:
    """One row per thread: messages stored, last turn, last message. Combines on the map side."""
    last = F.max_by(F.struct("role", "text"), turn)
    return messages.groupBy(thread).agg(
        F.count(F.lit(1)).alias("n_messages"), F.max(turn).alias("last_turn"), last.alias("last"),
    ).select(thread, "n_messages", "last_turn", F.col("last.role").alias("last_role"), F.col("last.text").alias("last_text"))
