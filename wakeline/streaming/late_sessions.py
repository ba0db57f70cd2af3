"""Sessions that stay open to late rows for a while after they have closed, as a log of changes.

Spark has no update mode for session windows.  Here a session fires when its gap has passed, and when a late
row changes it, what was fired is taken back and the new session fired; a row that joins two
sessions takes back both.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from wakeline.functions.timecols import MINUTE, SECOND, ms

_SESSIONS = StructType([StructField("sessions", ArrayType(StructType([
    StructField("first", LongType()), StructField("last", LongType()), StructField("n", LongType()), StructField("fired", BooleanType())])))])
_CHANGE = StructType([StructField("user_id", StringType()), StructField("window_start_ms", LongType()),
                      StructField("window_end_ms", LongType()), StructField("count", LongType()), StructField("retracted", BooleanType())])


class LateSessions(StatefulProcessor):
    """Keeps a user's sessions, sorted and apart by more than the gap, until no row can reach them.

    The watermark lies ``lateness`` ms behind the time at which sessions close.  State is at most one session
    per gap of the time between the watermark and the user's newest row.  A user has a timer for what comes next only:
    the first session to fire or to be forgotten.
    """

    def __init__(self, gap: int, lateness: int):
        self.gap = gap
        self.lateness = lateness

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sessions = handle.getValueState("sessions", _SESSIONS)

    def _held(self) -> list[tuple]:
        state = self.sessions.get()
        return [tuple(s) for s in state[0]] if state else []

    def _next(self, session: tuple) -> int:
        """When a session fires, or is forgotten if it has."""
        return session[1] + self.gap - (0 if session[3] else self.lateness)

    def _row(self, user: str, session: tuple, retracted: bool) -> Row:
        return Row(user_id=user, window_start_ms=session[0], window_end_ms=session[1] + self.gap, count=session[2], retracted=retracted)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        closed = timerValues.getCurrentWatermarkInMs() + self.lateness
        held = self._held()
        pieces = sorted(held + [(row.t, row.t, 1, None) for row in rows], key=lambda p: p[:3])  # None: a new row
        merged: list[list[tuple]] = []
        last = None
        for piece in pieces:
            if last is not None and piece[0] - last <= self.gap:
                merged[-1].append(piece)
                last = max(last, piece[1])
            else:
                merged.append([piece])
                last = piece[1]
        out = []
        for group in merged:
            if len(group) == 1 and group[0][3] is not None:
                out.append(group[0])
                continue
            for piece in group:
                if piece[3]:
                    yield self._row(key[0], piece, True)
            first, last, n = group[0][0], max(p[1] for p in group), sum(p[2] for p in group)
            fired = last + self.gap <= closed
            session = (first, last, n, fired)
            if fired:
                yield self._row(key[0], session, False)
            out.append(session)
        self.sessions.update((out,))
        # one that a session of before had is still there
        due = min(map(self._next, out))
        if due < min(map(self._next, held), default=due + 1):
            self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        held, left = self._held(), []
        for session in held:
            end = session[1] + self.gap
            if not session[3] and end <= now + self.lateness:
                session = (*session[:3], True)
                yield self._row(key[0], session, False)
            if end > now:
                left.append(session)
        if left:
            if left != held:
                self.sessions.update((left,))
            self.handle.registerTimer(min(map(self._next, left)))
        elif held:
            self.sessions.clear()


def session_changes(df: DataFrame, gap: int = 30 * SECOND, lateness: int = MINUTE) -> DataFrame:
    """(user_id, window_start_ms, window_end_ms, count, retracted): sessions as in ``windows.session_counts``, fired
    when they close and again after each micro-batch with late rows for them, with what no longer holds taken back.

    ``df`` has a watermark on ``ts`` of the usual delay plus ``lateness``; a session closes when the delay has
    passed.  Rows at or behind the watermark are dropped.  Needs the RocksDB state store.  Rows of null users
    are one user's.
    """
    rows = df.select("user_id", "ts", ms().alias("t")).filter(F.col("t").isNotNull())
    return rows.groupBy("user_id").transformWithState(LateSessions(gap, lateness), outputStructType=_CHANGE, outputMode="append", timeMode="eventTime")


def standing(changes: DataFrame) -> DataFrame:
    """The sessions that hold after all changes, in whatever order they are read."""
    sign = F.when(F.col("retracted"), -1).otherwise(1)
    return changes.groupBy("user_id", "window_start_ms", "window_end_ms", "count").agg(F.sum(sign).alias("n")).filter("n > 0").drop("n")
