"""Two-stage pattern alerts on a stream, as soon as the watermark reaches the last event of a match."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType, TimestampType)

from wakeline.functions.timecols import ms
from wakeline.operators.patterns import above_watermark, cell_width, spread_over_cells, units, units_to_usd
from wakeline.operators.stages import flags
from wakeline.streaming.clock import moment

_SLOT = StructType([StructField("start", LongType())])
_EVENTS = StructType([StructField("events", ArrayType(StructType([
    StructField("t", LongType()), StructField("rank", StringType()), StructField("first", BooleanType()),
    StructField("more", BooleanType()), StructField("units", LongType())])))])
_HELD = StructType([StructField("done", LongType()), StructField("slotted", BooleanType()), *_EVENTS.fields])
#: Events of a (user, time cell) up to this number lie in one value; more go to slots.
SMALL = 64
_MATCH = StructType([StructField("user_id", StringType()), StructField("purchase_count", IntegerType()),
                     StructField("total_units", LongType()), StructField("first_ts", LongType()), StructField("last_ts", LongType()), StructField("ts", TimestampType())])


class StagedProcessor(StatefulProcessor):
    """Holds the events of a (user, time cell) and works them off in time order.

    A call to the state costs more than a few events, so up to ``SMALL`` events are one value that is read and written
    whole.  More of them go to slots of ``within`` ms: a timer then reads only the slots that the newly reached events can match
    with, so a call costs the events of the last ``within`` ms, not those of the cell.  Slots behind that are removed.
    A key has a timer for what comes next only: the first event that may end a match, or the end of its cell.
    """

    def __init__(self, min_more: int, within: int, width: int):
        self.min_more = min_more
        self.within = within
        self.width = width
        self.small = SMALL

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", _HELD)  # events up to ``done`` have been worked off
        self.slots = handle.getMapState("slots", _SLOT, _EVENTS)

    def _slots(self, low: int, high: int) -> Iterator[int]:
        return iter(range(low - low % self.within, high + 1, self.within))

    def _to_slots(self, events: list) -> None:
        fresh: dict[int, list] = {}
        for e in events:
            fresh.setdefault(e[0] - e[0] % self.within, []).append(e)
        for start, part in fresh.items():
            self.slots.updateValue((start,), (self._slot(start) + part,))

    def _slot(self, start: int) -> list:
        return [tuple(e) for e in self.slots.getValue((start,))[0]] if self.slots.containsKey((start,)) else []

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        cell, end = key[1], key[1] + self.width
        fresh = [(row.t, row.rank, row.first, row.more, row.units) for row in rows]
        state = self.held.get()
        # before the first event that a copy from the cell before can have
        done, slotted, events = state if state else (cell - self.within - 1, False, [])
        if slotted:
            self._to_slots(fresh)
        else:
            events = [tuple(e) for e in events] + fresh
            if len(events) > self.small:
                self._to_slots(events)
                slotted, events = True, []
            self.held.update((done, slotted, events))
        waiting = [e[0] for e in fresh if e[3] and e[0] >= cell]
        if waiting:
            self.handle.registerTimer(min(waiting))
        elif not state:
            self.handle.registerTimer(end)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        user, cell = key
        now, end = timerValues.getCurrentWatermarkInMs(), key[1] + self.width
        state = self.held.get()
        if not state or now <= state[0]:
            return
        done, slotted, events = state
        if slotted:
            events = [e for start in self._slots(max(done + 1, cell) - self.within, min(now, end)) for e in self._slot(start)]
        else:
            events = [tuple(e) for e in events]
        events.sort(key=lambda e: (e[0], e[1], e[2], e[3]))
        yield from self._matches(user, cell, done, [e for e in events if e[0] <= now])
        if now >= end:
            self.held.clear()
            if slotted:
                self.slots.clear()
            return
        if slotted:
            for (start,) in list(self.slots.keys()):
                if start + self.within <= now - self.within:
                    self.slots.removeKey((start,))
            self.held.update((now, True, []))
            ahead = []
            for start in self._slots(now + 1, end - 1):
                ahead = [e[0] for e in self._slot(start) if e[3] and e[0] > now and e[0] >= cell]
                if ahead:
                    break
        else:
            self.held.update((now, False, [e for e in events if e[0] > now - self.within]))
            ahead = [e[0] for e in events if e[3] and e[0] > now and e[0] >= cell]
        self.handle.registerTimer(min(ahead, default=end))

    def _matches(self, user: str, cell: int, done: int, events: list) -> Iterator[Row]:
        starts: list[tuple] = []  # (t, later events so far, their sum without this event's amount)
        times: list[int] = []
        counts: list[int] = []
        mores = paid = 0
        for t, _, first, more, amount in events:
            amount = amount or 0
            before = paid
            if more:
                mores += 1
                paid += amount
                if t > done and t >= cell:
                    low = bisect_right(times, t - self.within)
                    high = bisect_right(counts, mores - self.min_more)
                    for at, n, base in starts[low:high]:
                        yield Row(user_id=user, purchase_count=mores - n + 1, total_units=paid - base, first_ts=at, last_ts=t, ts=moment(t))
            if first:
                starts.append((t, mores, (before if more else paid - amount)))
                times.append(t)
                counts.append(mores)


def staged_purchases_stream(purchases: DataFrame, first: Column, more: Column, min_more: int, within: int,
                            order: tuple[str, ...] = ("product_id", "amount_usd"), timed: bool = False) -> DataFrame:
    """``stages.staged_purchases`` on a stream; needs a watermark on ``ts`` and the RocksDB state store.

    With ``timed`` the alerts have an event time ``ts``, that of their last event, for stateful steps that follow.

    State per (user, time cell) is the events of at most the open cell; a busy user's cells are keys of their own.
    """
    named = purchases.withColumns(dict(zip(("first", "more"), flags(first, more))))
    named = named.filter(above_watermark(F.col("first") | F.col("more")))
    # one comparable text for the columns that rank events of equal time: nulls first, numbers by value
    parts = [_sortable(purchases, c) for c in order]
    events = named.select("user_id", "ts", ms().alias("t"), F.concat_ws("\0", *parts).alias("rank"), "first", "more", units().alias("units"))
    cells = spread_over_cells(events.filter(F.col("t").isNotNull() & F.col("user_id").isNotNull()), within)
    found = cells.groupBy("user_id", "cell").transformWithState(
        StagedProcessor(min_more, within, cell_width(within)), outputStructType=_MATCH, outputMode="append", timeMode="eventTime",
        eventTimeColumnName="ts" if timed else "")
    alerts = found.select("user_id", "purchase_count", units_to_usd(F.col("total_units")).alias("total_amount_usd"),
                        "first_ts", "last_ts", (F.col("last_ts") - F.col("first_ts")).alias("span_ms"), "ts")
    return alerts if timed else alerts.drop("ts")


def _sortable(df: DataFrame, column: str) -> Column:
    """Text that sorts as the column does."""
    if dict(df.dtypes)[column] == "string":
        return F.coalesce(F.concat(F.lit("1"), F.col(column)), F.lit("0"))
    amount = F.col(column).cast("decimal(38,9)")
    # shifted to be positive, then of equal length
    shifted = F.lpad((amount + F.expr("10000000000000000000BD")).cast("string"), 40, "0")
    return F.coalesce(F.concat(F.lit("1"), shifted), F.lit("0"))
