"""Alerts of young accounts on a stream: the first event of every user is kept as state."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from wakeline.functions.timecols import DAY, MINUTE, duration, ms

_TIME = StructType([StructField("t", LongType())])


class YoungAccounts(StatefulProcessor):
    """Keeps the earliest event of a user and the alerts that an earlier event may still make too old.

    State is one number per user for good, and the alerts of a user who may be young that begin in a cell the watermark has
    not passed.
    """

    def __init__(self, max_age: int, settle: int, alert: StructType):
        self.max_age = max_age
        self.settle = settle
        self.alert = alert

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", _TIME)
        self.waiting = handle.getListState("waiting", self.alert)

    def _seen(self, t: int) -> None:
        least = self.first.get()
        if not least or t < least[0]:
            self.first.update((t,))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._seen(initialState.seen_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        seen, alerts, cells = [], [], set()
        state = self.first.get()
        least = state[0] if state else None
        for row in rows:
            if row.seen_ms is not None:
                seen.append(row.seen_ms)
            elif least is None or row.first_ts - least <= self.max_age:
                alerts.append(tuple(row[name] for name in self.alert.names))
                cells.add(row.first_ts - row.first_ts % self.settle + self.settle)
        if seen and (least is None or min(seen) < least):
            self.first.update((min(seen),))
        for cell in cells:
            self.handle.registerTimer(cell)
        if alerts:
            self.waiting.appendList(alerts)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now, at = timerValues.getCurrentWatermarkInMs(), self.alert.names.index("first_ts")
        held = [tuple(a) for a in self.waiting.get()] if self.waiting.exists() else []
        if not held:
            return
        least = self.first.get()[0]
        left = []
        for alert in held:
            age = alert[at] - least
            if age > self.max_age:
                continue
            if alert[at] - alert[at] % self.settle + self.settle > now:
                left.append(alert)
            else:
                yield Row(**dict(zip(self.alert.names, alert)), account_age_ms=age)
        if left:
            self.waiting.put(left)
        else:
            self.waiting.clear()


def new_account_bursts_stream(alerts: DataFrame, activity: DataFrame, max_age: int = 7 * DAY, known: DataFrame | None = None,
                              settle: int = MINUTE) -> DataFrame:
    """``patterns.new_account_bursts`` on streams: alerts that begin at most ``max_age`` ms after the first event of their user.

    ``alerts`` (with ``user_id``, ``first_ts`` and an event time ``ts``, as ``staged_purchases_stream(timed=True)`` gives) begin with an
    event of ``activity``, which has a watermark on ``ts``.  ``known`` is a stored table of earlier activity: (user_id, ts).

    Activity is folded to the first event per user and ``settle`` ms before the shuffle; an alert waits until that cell of its first event
    has passed, because an earlier event in it may still come.  Needs the RocksDB state store.  The first events are kept for
    good: a user who was forgotten would look new again.
    """
    alert = StructType([f for f in alerts.schema.fields if f.name != "ts"])
    firsts = activity.filter(F.col("user_id").isNotNull()).groupBy(F.window("ts", duration(settle)).alias("w"), "user_id").agg(F.min(ms()).alias("seen_ms"))
    others = [F.lit(None).cast(f.dataType).alias(f.name) for f in alert.fields if f.name != "user_id"]
    seen = firsts.select("user_id", F.window_time("w").alias("ts"), "seen_ms", *others)
    made = alerts.withColumn("seen_ms", F.lit(None).cast("bigint"))
    start = None
    if known is not None:
        start = known.filter(F.col("user_id").isNotNull() & F.col("ts").isNotNull()).groupBy("user_id").agg(F.min(ms()).alias("seen_ms")).groupBy("user_id")
    out = StructType([*alert.fields, StructField("account_age_ms", LongType())])
    return seen.unionByName(made).groupBy("user_id").transformWithState(
        YoungAccounts(max_age, settle, alert), outputStructType=out, outputMode="append", timeMode="eventTime", initialState=start)
