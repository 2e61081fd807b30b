"""Queues whose items advance with events that arrive over time: a state a key, kept by the stream, with deadlines."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

RESULT = "key string, step long, status string, event string, at timestamp"


class Advancing(StatefulProcessor):
    """An item's status by a table of transitions (from, event, to); events of one batch are taken in order of their times, then of their names.

    An event that the table does not name for the status leaves it; an item without a status has ``start``. Each change is a
    row, numbered by item. With ``deadline_ms``, an item that stays in ``waiting`` that long in event time goes to ``expired``.
    """

    def __init__(self, transitions: list[tuple[str, str, str]], start: str, waiting: str | None = None, expired: str | None = None, deadline_ms: int = 0):
        self.table = {(before, event): after for before, event, after in transitions}
        self.start, self.waiting, self.expired, self.deadline_ms = start, waiting, expired, deadline_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.status = handle.getValueState("status", "status string, step long, until long")

    def _held(self) -> tuple[str, int, int] | None:
        return self.status.get()

    def _keep(self, status: str, step: int, until: int, due: int) -> None:
        """The state after the changes of a batch, and the timer that goes with it: each costs a call to the JVM, so there is one a batch."""
        if until != due:
            if until:
                self.handle.deleteTimer(until)
            if due:
                self.handle.registerTimer(due)
        self.status.update((status, step, due))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [(part["at"], part["event"]) for part in rows]
        events = sorted((at, event) for times, names in parts for at, event in zip(times, names))
        held = self._held()
        status, step, until = held or (self.start, 0, 0)
        timed = lambda status, at: int(at.timestamp() * 1000) + self.deadline_ms if self.deadline_ms and status == self.waiting else 0
        due, changes = until if held else timed(status, events[0][0]), []
        for at, event in events:
            after = self.table.get((status, event))
            if after is not None:
                status, step, due = after, step + 1, timed(after, at)
                changes.append((key[0], step, status, event, at))
        if changes or due != until:
            self._keep(status, step, until, due)
        if changes:
            yield pd.DataFrame(changes, columns=["key", "step", "status", "event", "at"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        status, step, until = self._held() or (self.start, 0, 0)
        at = expiredTimerInfo.getExpiryTimeInMs()
        if status == self.waiting and until == at:
            self.status.update((self.expired, step + 1, 0))
            yield pd.DataFrame([(key[0], step + 1, self.expired, "deadline", pd.Timestamp(at, unit="ms"))], columns=["key", "step", "status", "event", "at"])

    def close(self) -> None:
        pass


def advancing(events: DataFrame, transitions: list[tuple[str, str, str]], start: str = "pending", waiting: str | None = None, expired: str | None = None, deadline_ms: int = 0, late: str = "0 seconds") -> DataFrame:
    """Of a stream of ``events`` (key, event, at) the changes of status: key, step, status, event, at, as ``Advancing`` says.

    The state lies in RocksDB and the checkpoint, so a query that is started again goes on where it stopped: no change is given twice and none is lost.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    mode = "eventtime" if deadline_ms else "none"
    processor = Advancing(transitions, start, waiting, expired, deadline_ms)
    rows = events.withWatermark("at", late) if deadline_ms else events
    return rows.groupBy("key").transformWithStateInPandas(processor, RESULT, "append", mode)


def drained(changes: DataFrame, path: str, checkpoint: str) -> None:
    """Write what there is of ``changes`` to the parquet table ``path``, then stop; the next call goes on from there."""
    changes.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
