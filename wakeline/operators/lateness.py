"""Watermarks and late data over a stored event log.

A replay needs to know what had arrived before: rows carry ``batch`` (bigint, ascending arrival
batches) and ``arrival_ms``.  The watermark in force for a row is the largest event time of all
earlier batches minus the delay; rows of the first batch have none and are never late.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wakeline.functions.running import running
from wakeline.functions.timecols import DEFAULT_DELAY, MINUTE, SECOND, floor_to, ms

# batches folded per task in the running maximum
CHUNK = 65_536


def arrival_watermarks(log: DataFrame, delay: int = DEFAULT_DELAY) -> DataFrame:
    """``(batch, watermark_ms)``: what was in force while each batch was worked on."""
    tops = log.groupBy("batch").agg(F.max(ms()).alias("top_ms"))
    return (running(tops, "batch", {"top_ms": "max"}, CHUNK, inclusive=False)
            .select("batch", (F.col("top_ms") - delay).alias("watermark_ms")))


def replay_watermarks(log: DataFrame, delay: int = DEFAULT_DELAY) -> DataFrame:
    """Each row with the watermark in force at its arrival, ``is_late`` and the watermark's lag."""
    event_ms = ms()
    return (log.join(arrival_watermarks(log, delay), "batch")
            .withColumn("is_late", F.coalesce(event_ms < F.col("watermark_ms"), F.lit(False)))
            .withColumn("lag_ms", F.greatest(F.lit(0), F.col("arrival_ms") - F.col("watermark_ms"))
                        * F.when(F.col("watermark_ms").isNotNull(), F.lit(1))))


def late_counts(log: DataFrame, delay: int = DEFAULT_DELAY) -> DataFrame:
    """Rows behind and not behind the watermark at their arrival."""
    return replay_watermarks(log, delay).groupBy("is_late").agg(F.count(F.lit(1)).alias("count"))


def late_side_output(log: DataFrame, size: int = 10 * SECOND, delay: int = DEFAULT_DELAY) -> DataFrame:
    """Rows that reach a tumbling window after it has closed."""
    end = floor_to(ms(), size) + size
    return (replay_watermarks(log, delay).withColumn("window_end_ms", end)
            .filter(F.col("window_end_ms") <= F.col("watermark_ms")))


def _arrivals_by_window(log: DataFrame, size: int, delay: int) -> DataFrame:
    """``(batch, window, count, watermark)``, folded before the join with the watermarks."""
    start = floor_to(ms(), size).alias("window_start_ms")
    folded = log.groupBy("batch", start).agg(F.count(F.lit(1)).alias("n"))
    return (folded.join(arrival_watermarks(log, delay), "batch")
            .withColumn("window_end_ms", F.col("window_start_ms") + size))


def late_dropped_windows(log: DataFrame, size: int = 10 * SECOND, delay: int = DEFAULT_DELAY) -> DataFrame:
    """Dropped rows per window that had closed before they arrived."""
    late = _arrivals_by_window(log, size, delay).filter(F.col("window_end_ms") <= F.col("watermark_ms"))
    return late.groupBy("window_start_ms", "window_end_ms").agg(F.sum("n").alias("dropped"))


def allowed_lateness(log: DataFrame, size: int = 10 * SECOND, delay: int = DEFAULT_DELAY,
                     lateness: int = MINUTE) -> DataFrame:
    """Final counts per window when a window stays open ``lateness`` ms after it closes.

    ``on_time`` is the count at first firing, ``refired`` what later firings added.
    """
    end, mark = F.col("window_end_ms"), F.col("watermark_ms")
    on_time = mark.isNull() | (end > mark)
    kept = on_time | (end > mark - lateness)
    sums = (_arrivals_by_window(log, size, delay).filter(kept).groupBy("window_start_ms", "window_end_ms")
            .agg(F.sum("n").alias("count"), F.sum(F.when(on_time, F.col("n")).otherwise(F.lit(0))).alias("on_time")))
    return sums.withColumn("refired", F.col("count") - F.col("on_time"))


def lag_band(lag: Column, slow: int = 5 * SECOND, stuck: int = 30 * SECOND) -> Column:
    return F.when(lag < slow, "ok").when(lag < stuck, "slow").otherwise("stuck")


def watermark_lag_bands(log: DataFrame, delay: int = DEFAULT_DELAY, slow: int = 5 * SECOND,
                        stuck: int = 30 * SECOND) -> DataFrame:
    """Rows per band of watermark lag; rows without a watermark are left out."""
    known = replay_watermarks(log, delay).filter(F.col("watermark_ms").isNotNull())
    return known.groupBy(lag_band(F.col("lag_ms"), slow, stuck).alias("band")).agg(F.count(F.lit(1)).alias("count"))


def min_watermark(log: DataFrame, partitions: list[int], delay: int = DEFAULT_DELAY,
                  partition: str = "partition") -> DataFrame:
    """Watermark after each batch when every source partition has its own and the least one wins.

    A partition absent from a batch keeps its last value; until all have been seen there is none.
    """
    slots = {f"p{i}": value for i, value in enumerate(partitions)}
    tops = log.groupBy("batch", partition).agg(F.max(ms()).alias("top_ms"))
    per_batch = tops.groupBy("batch").agg(
        *[F.max(F.when(F.col(partition) == value, F.col("top_ms"))).alias(name) for name, value in slots.items()])
    filled = running(per_batch, "batch", {name: "max" for name in slots}, CHUNK)
    seen = F.lit(True)
    for name in slots:
        seen = seen & F.col(name).isNotNull()
    least = F.least(*slots) if len(slots) > 1 else F.col("p0")
    most = F.greatest(*slots) if len(slots) > 1 else F.col("p0")
    return filled.select("batch", F.when(seen, least - delay).alias("min_watermark_ms"),
                         (most - delay).alias("max_watermark_ms"))


def event_vs_arrival(log: DataFrame, size: int = 10 * SECOND) -> DataFrame:
    """The same events counted by event time and by arrival time, window by window."""
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    # one pass: every row adds to its window on each clock
    ticks = log.select(F.explode(F.array(
        F.struct(floor_to(ms(), size).alias("start"), one.alias("e"), zero.alias("a")),
        F.struct(floor_to(F.col("arrival_ms"), size).alias("start"), zero.alias("e"), one.alias("a")))).alias("x"))
    return (ticks.groupBy(F.col("x.start").alias("window_start_ms"))
            .agg(F.sum("x.e").alias("by_event_time"), F.sum("x.a").alias("by_arrival"))
            .select("window_start_ms", (F.col("window_start_ms") + size).alias("window_end_ms"),
                    "by_event_time", "by_arrival"))
