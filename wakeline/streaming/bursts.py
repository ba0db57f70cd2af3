"""Rapid-purchase alerts on a stream as soon as the watermark reaches the last event of a run.

``patterns.rapid_purchases`` gives the same alerts from built-in aggregates when a time cell
closes, which is cheaper; this form keeps event-time ordered state and timers in Python workers
and is for alerts that cannot wait for the cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wakeline.functions.timecols import SECOND
from wakeline.operators.patterns import above_watermark
from wakeline.streaming.stages import staged_purchases_stream


def rapid_purchases_stream(purchases: DataFrame, min_times: int = 3, within: int = 10 * SECOND,
                           where: Column | None = None, timed: bool = False) -> DataFrame:
    """The alerts of ``patterns.rapid_purchases`` (``min_times`` of two or more) without delay: two-stage patterns of which every
    event meets both conditions.

    Needs a watermark on ``ts`` and the RocksDB state store.  A call reads the events of the last ``within`` ms, not those
    of the whole cell.  ``timed``: the alerts have an event time ``ts``, that of their last event.
    """
    if min_times < 2:
        raise ValueError("min_times must be at least 2")
    if where is not None:
        purchases = purchases.filter(above_watermark(where))
    return staged_purchases_stream(purchases, F.lit(True), F.lit(True), min_times - 1, within, timed=timed)
