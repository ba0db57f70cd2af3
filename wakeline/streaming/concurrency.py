"""How many sessions are open at every moment, on a stream.

A closed session comes too late to be counted among those that were open with it.  So sessions announce
themselves: their start once the watermark reaches it, their end when the gap has passed, and the start
of every chunk of time they reach into.  Each chunk then knows how many sessions it begins with,
and is swept by itself when the watermark has passed it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, LongType, StructField, StructType, TimestampType

from wakeline.functions.timecols import MINUTE, SECOND, duration, ms
from wakeline.streaming.clock import moment

_SESSIONS = StructType([StructField("sessions", ArrayType(StructType([
    StructField("first", LongType()), StructField("last", LongType())])))])
_TIME = StructType([StructField("t", LongType())])
_CHANGE = StructType([StructField("at", TimestampType()), StructField("at_ms", LongType()), StructField("d", LongType())])


class SessionChanges(StatefulProcessor):
    """Keeps a user's open sessions as (first, last event), sorted, and tells their changes in order of time.

    What lies at or behind the watermark is final: Spark drops rows from there, so no session can begin,
    grow or merge there any more.  State is the sessions that have not ended at the watermark, at most one per gap
    of the time between it and the user's newest row.
    """

    def __init__(self, gap: int, chunk: int):
        self.gap = gap
        self.chunk = chunk

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sessions = handle.getValueState("sessions", _SESSIONS)
        self.told = handle.getValueState("told", _TIME)  # changes up to here have been told

    def _next(self, first: int, last: int, told: int | None) -> int:
        """The first moment after ``told`` at which a session changes or enters a chunk."""
        if told is None or told < first:
            return first
        return min(last + self.gap, told - told % self.chunk + self.chunk)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = [tuple(s) for s in self.sessions.get()[0]] if self.sessions.exists() else []
        merged: list[tuple] = []
        for first, last in sorted(held + [(row.t, row.t) for row in rows]):
            if merged and first - merged[-1][1] <= self.gap:
                merged[-1] = (merged[-1][0], max(merged[-1][1], last))
            else:
                merged.append((first, last))
        self.sessions.update((merged,))
        self.handle.registerTimer(self._next(*merged[0], self.told.get()[0] if self.told.exists() else None))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.sessions.exists():
            return
        now = timerValues.getCurrentWatermarkInMs()
        told = self.told.get()[0] if self.told.exists() else None
        if told is not None and now <= told:
            return
        held = [tuple(s) for s in self.sessions.get()[0]]
        left = []
        for first, last in held:
            end = last + self.gap
            if first <= now and (told is None or first > told):
                yield Row(at=moment(first), at_ms=first, d=1)
            # entered with, not changed at: no moment of its own
            after = first if told is None else max(first, told)
            for boundary in range(after - after % self.chunk + self.chunk, min(end, now) + 1, self.chunk):
                yield Row(at=moment(boundary), at_ms=None, d=1)
            if end <= now:
                yield Row(at=moment(end), at_ms=end, d=-1)
            else:
                left.append((first, last))
        if left:
            self.sessions.update((left,))
            self.told.update((now,))
            self.handle.registerTimer(self._next(*left[0], now))
        else:
            self.sessions.clear()
            self.told.clear()


@F.pandas_udf(ArrayType(LongType()))
def _running(carried: pd.Series, changes: pd.Series) -> pd.Series:
    return pd.Series([c + d.cumsum() for c, d in zip(carried, changes)])


def concurrent_sessions(df: DataFrame, gap: int = 30 * SECOND, chunk: int = MINUTE) -> DataFrame:
    """(at_ms, open): the number of open sessions after every moment at which one begins or ends, as
    ``results.concurrency`` over ``windows.session_counts``, once per chunk of ``chunk`` ms that has passed.

    ``df`` has a watermark on ``ts``; needs the RocksDB state store.  A session costs one row per chunk it reaches into,
    folded with the others before the shuffle; a chunk holds one number per moment, ``chunk`` at most.  Rows of null users
    are one user's, as in ``windows.session_counts``.
    """
    rows = df.select("user_id", "ts", ms().alias("t")).filter(F.col("t").isNotNull())
    changes = rows.groupBy("user_id").transformWithState(
        SessionChanges(gap, chunk), outputStructType=_CHANGE, outputMode="append", timeMode="eventTime", eventTimeColumnName="at")
    net = changes.groupBy(F.window("at", duration(chunk)).alias("w"), "at_ms").agg(F.sum("d").alias("d"))
    swept = net.groupBy("w").agg(F.sort_array(F.collect_list(F.when(F.col("at_ms").isNotNull(), F.struct("at_ms", "d")))).alias("x"),
                                 F.coalesce(F.sum(F.when(F.col("at_ms").isNull(), F.col("d"))), F.lit(0)).alias("carried"))
    return swept.filter(F.size("x") > 0).select(
        F.explode(F.arrays_zip(F.col("x.at_ms").alias("at_ms"), _running("carried", "x.d").alias("open"))).alias("e")).select("e.*")
