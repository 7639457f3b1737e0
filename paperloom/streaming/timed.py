"""Keyed state with timers: polling that gives up, and stalls told while they last.

Both wait for the watermark before they speak, so what comes out does not depend on the order of arrival within it, and equals
what the batch forms below make of all rows. The streams need the RocksDB state store (``STATE_STORE``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.window import Window

from paperloom.streaming.state import TERMINAL

STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
GIVE_UP_SECONDS, STALL_SECONDS = 7200, 900
GAVE_UP = "gave_up"
TASK = "task"


class _Timed(StatefulProcessor):
    """One timer a key."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def due(self, at: int | None) -> None:
        for known in list(self.handle.listTimers()):
            known = known[0] if isinstance(known, tuple) else known
            if known == at:
                return
            self.handle.deleteTimer(known)
        if at is not None:
            self.handle.registerTimer(at)

    def close(self) -> None:
        pass


class Poll(_Timed):
    """Of a task's rows: when it was submitted, and its terminal answers until one is settled."""

    def __init__(self, seconds: int) -> None:
        self.patience = seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.task = handle.getValueState("task", "submitted long, closed boolean")
        self.answers = handle.getListState("answers", "at long, state string")

    def outcome(self, key: tuple, now: int) -> Iterator[pd.DataFrame]:
        """Tells what is settled at the watermark ``now`` and sets the timer for what is not."""
        task = self.task.get() if self.task.exists() else None
        answers = sorted(set(map(tuple, self.answers.get()))) if self.answers.exists() else []
        if task is None:
            # A task of an answer's time or before can no longer come once the watermark is past the answer.
            answers = [a for a in answers if a[0] >= now]
            self.keep(answers)
            self.due(answers[0][0] + 1 if answers else None)
            return
        submitted, closed = task
        deadline = submitted + self.patience
        if not closed:
            valid = [a for a in answers if submitted <= a[0] <= deadline]
            at, state = valid[0] if valid else (deadline, GAVE_UP)
            if now <= at:
                self.due(at + 1)
                return
            yield pd.DataFrame({"data_id": [key[0]], "state": [state], "at": [at]})
            self.task.update((submitted, True))
            self.answers.clear()
        # What was told is remembered up to the deadline: repeated rows say nothing until then.
        if now > deadline:
            self.task.clear()
            self.answers.clear()
            self.due(None)
        else:
            self.due(deadline + 1)

    def keep(self, answers: list[tuple]) -> None:
        if answers:
            self.answers.put(answers)
        else:
            self.answers.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        task = self.task.get() if self.task.exists() else None
        found = []
        for part in rows:
            for state, at in zip(part["state"], part["at"].tolist(), strict=True):
                if state == TASK:
                    task = (at, False) if task is None else (min(task[0], at), task[1])
                else:
                    found.append((at, state))
        if task is not None:
            self.task.update(task)
        if found and not (task and task[1]):
            self.answers.appendList(found)
        yield from self.outcome(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        yield from self.outcome(key, max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()))


def _polled(tasks: DataFrame, answers: DataFrame) -> DataFrame:
    at = F.unix_millis("ts").alias("at")
    return tasks.select("data_id", F.lit(TASK).alias("state"), "ts", at).unionByName(answers.where(F.col("state").isin(*TERMINAL)).select("data_id", "state", "ts", at))


def poll(tasks: DataFrame, answers: DataFrame, late: str = "10 minutes", seconds: int = GIVE_UP_SECONDS) -> DataFrame:
    """Streams of tasks (data_id, ts) and answers (data_id, state, ts): each task once, as (data_id, state, ts), with its first
    terminal answer within ``seconds`` of its submission, or as given up at the end of them.

    A repeated task counts from its first row; one that is submitted again after its time was up is a new one. State of a task is
    dropped when its time is up, that of an answer without a task when none can come any more. The clock is the slower of both
    streams' watermarks.
    """
    rows = _polled(tasks.withWatermark("ts", late), answers.withWatermark("ts", late))
    told = rows.groupBy("data_id").transformWithStateInPandas(Poll(seconds), "data_id string, state string, at long", "Append", "EventTime")
    return told.select("data_id", "state", F.timestamp_millis("at").alias("ts"))


def poll_batch(tasks: DataFrame, answers: DataFrame, seconds: int = GIVE_UP_SECONDS) -> DataFrame:
    """The same of tables, with the times in whole milliseconds, where every task's time is up."""
    whole = lambda df: df.withColumn("ts", F.date_trunc("MILLISECOND", "ts"))
    asked = whole(tasks).where("data_id is not null").groupBy("data_id").agg(F.min("ts").alias("submitted"))
    deadline = F.col("submitted") + F.make_dt_interval(secs=F.lit(seconds))
    given = whole(answers).where(F.col("state").isin(*TERMINAL))
    met = asked.join(given.select(F.col("data_id").alias("__id"), "state", "ts"), (F.col("data_id") == F.col("__id")) & (F.col("ts") >= F.col("submitted")) & (F.col("ts") <= deadline), "left")
    best = met.groupBy("data_id", "submitted").agg(F.min(F.struct("ts", "state")).alias("b"))
    given_up = F.col("b.ts").isNull()
    return best.select("data_id", F.when(given_up, GAVE_UP).otherwise(F.col("b.state")).alias("state"), F.when(given_up, deadline).otherwise(F.col("b.ts")).alias("ts"))


class Stall(_Timed):
    """Of a key's events: those that no later one is known to follow in time."""

    def __init__(self, seconds: int) -> None:
        self.gap = seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.open = handle.getListState("open", "at long")

    def settled(self, key: tuple, found: list[int], now: int) -> Iterator[pd.DataFrame]:
        held = sorted({*found, *((x[0] for x in self.open.get()) if self.open.exists() else ())})
        stalls, i = [], 0
        while i < len(held):
            followed = i + 1 < len(held) and held[i + 1] - held[i] < self.gap
            if not followed and now < held[i] + self.gap:
                break
            if not followed:
                stalls.append(held[i])
            i += 1
        held = held[i:]
        if held:
            self.open.put([(x,) for x in held])
        else:
            self.open.clear()
        self.due(held[0] + self.gap if held else None)
        if stalls:
            yield pd.DataFrame({"user_id": [key[0]] * len(stalls), "at": stalls})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        yield from self.settled(key, [at for part in rows for at in part["at"].tolist()], timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        yield from self.settled(key, [], max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()))


def stalls(events: DataFrame, late: str = "1 minute", seconds: int = STALL_SECONDS) -> DataFrame:
    """A stream of events (user_id, ts) to (user_id, quiet_since): told as soon as the watermark shows that for ``seconds`` after an
    event nothing came, while the stall lasts. An event that is followed in time is forgotten at once, so a key holds few."""
    rows = events.select("user_id", "ts", F.unix_millis("ts").alias("at")).withWatermark("ts", late)
    told = rows.groupBy("user_id").transformWithStateInPandas(Stall(seconds), "user_id long, at long", "Append", "EventTime")
    return told.select("user_id", F.timestamp_millis("at").alias("quiet_since"))


def stalls_batch(events: DataFrame, seconds: int = STALL_SECONDS) -> DataFrame:
    """The same of a table, up to its last event."""
    times = events.select("user_id", F.date_trunc("MILLISECOND", "ts").alias("ts")).distinct()
    end = times.agg(F.max("ts").alias("__end"))
    following = times.withColumn("__next", F.lead("ts").over(Window.partitionBy("user_id").orderBy("ts"))).join(F.broadcast(end))
    until = F.coalesce("__next", "__end")
    return following.where(until >= F.col("ts") + F.make_dt_interval(secs=F.lit(seconds))).select("user_id", F.col("ts").alias("quiet_since"))
