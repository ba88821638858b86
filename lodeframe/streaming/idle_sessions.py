"""Sessions that end by a timer: what each field of a key was last, until the key has been idle.

Arbitrary state of a key: its open sessions, a map from start to end, and a map from
session and field to the field's count and latest value.  A key's one timer stands at
the end of the first session's idle time; when the watermark passes it, the session
is told and its state goes.  Till then late rows may lengthen it, or join it with the
next.  Rows that are older than the watermark are dropped by the engine before they
get here.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .windows import run_to_table

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COLUMNS = ["key", "started", "ended", "field", "n", "value"]


@dataclass
class Session:
    started: int
    ended: int
    #: count, moment of the latest and its value, by field
    fields: dict[str, tuple[int, int, float]]


def joined(a: tuple[int, int, float] | None, b: tuple[int, int, float]) -> tuple[int, int, float]:
    """Both counts, and the latest value; of one moment the largest."""
    return b if a is None else (a[0] + b[0], *max(a[1:], b[1:]))


class _Sessions(StatefulProcessor):
    """Rows ``key, at (microseconds), field, value`` into sessions with a gap of ``gap`` microseconds at most."""

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spans = handle.getMapState("spans", "started long", "ended long")
        self.fields = handle.getMapState("fields", "started long, field string", "n long, at long, value double")

    def _open(self) -> list[Session]:
        held = {started[0]: Session(started[0], ended[0], {}) for started, ended in self.spans.iterator()}
        for (started, name), latest in self.fields.iterator():
            held[started].fields[name] = tuple(latest)
        return list(held.values())

    def _keep(self, sessions: list[Session]) -> None:
        """Write the open sessions, and set the timer for the first that ends."""
        self.spans.clear()
        self.fields.clear()
        for s in sessions:
            self.spans.updateValue((s.started,), (s.ended,))
            for name, latest in s.fields.items():
                self.fields.updateValue((s.started, name), latest)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if sessions:
            self.handle.registerTimer(min(map(self._due, sessions)))

    def _due(self, s: Session) -> int:
        """The first millisecond after its idle time."""
        return (s.ended + self.gap) // 1000 + 1

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values("at", kind="stable")
        at, names, values = batch["at"].to_numpy(np.int64), batch["field"].to_numpy(), batch["value"].to_numpy(float)
        cuts = [0, *(np.flatnonzero(np.diff(at) > self.gap) + 1), len(at)]
        pieces = self._open()
        for a, b in zip(cuts, cuts[1:], strict=False):
            found: dict[str, tuple[int, int, float]] = {}
            for name, moment, value in zip(names[a:b], at[a:b].tolist(), values[a:b].tolist(), strict=True):
                found[name] = joined(found.get(name), (1, moment, value))
            pieces.append(Session(int(at[a]), int(at[b - 1]), found))
        pieces.sort(key=lambda s: s.started)
        merged = [pieces[0]]
        for s in pieces[1:]:
            last = merged[-1]
            if s.started > last.ended + self.gap:
                merged.append(s)
                continue
            last.ended = max(last.ended, s.ended)
            for name, latest in s.fields.items():
                last.fields[name] = joined(last.fields.get(name), latest)
        self._keep(merged)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        # all that are over by now: a timer that is set for the past waits for another batch
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        sessions = self._open()
        self._keep([s for s in sessions if self._due(s) > now])
        over = [(key[0], s.started, s.ended, name, n, value) for s in sessions if self._due(s) <= now for name, (n, _, value) in s.fields.items()]
        yield pd.DataFrame(over, columns=COLUMNS)

    def close(self) -> None:
        pass


def idle_sessions(stream: DataFrame, key: str, time: str, field: str, value: str, gap: str, late: str) -> DataFrame:
    """``key, started, ended, field, n, value`` of every session that has ended: how often a field came and its latest value.

    A session ends when the key has no row for more than ``gap``, by the watermark
    ``late`` behind the latest row; one that isn't over yet isn't told.  Rows without a
    key, time, field or value are left out.  A key's rows of one batch are held at once.
    """
    kind = dict(stream.dtypes)[key]
    micros = int(stream.sparkSession.sql(f"select cast(interval '{gap}' as interval day to second) as g").first()[0].total_seconds() * 1_000_000)
    rows = stream.select(F.col(key).alias("key"), F.col(time).cast("timestamp").alias("time"), F.col(field).cast("string").alias("field"), F.col(value).cast("double").alias("value")).dropna()
    rows = rows.withWatermark("time", late).withColumn("at", F.unix_micros("time"))
    out = rows.groupBy("key").transformWithStateInPandas(_Sessions(micros), f"key {kind}, started long, ended long, field string, n long, value double", "Append", "EventTime")
    moment = lambda c: F.timestamp_micros(c).cast("timestamp_ntz").alias(c)
    return out.select("key", moment("started"), moment("ended"), "field", "n", "value")


def run_idle_sessions(spark: SparkSession, stream: DataFrame, folder: str | None = None) -> DataFrame:
    """Run a stream of ``idle_sessions`` over what is there; its state is kept by a store that has map state and timers."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        return run_to_table(stream, "append", folder)
    finally:
        spark.conf.set(PROVIDER, before)
