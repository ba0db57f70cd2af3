"""Operators on result tables: latest, recent, de-duplicated, concurrent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wakeline.functions.running import running
from wakeline.functions.timecols import HOUR


def recent_n(results: DataFrame, order: list[Column], n: int = 50, by: str = "type") -> DataFrame:
    """The first ``n`` rows of every type in ``order`` (newest first), with their position.

    The rank filter becomes a group limit: at most ``n`` rows per type leave each map task.
    """
    ranked = results.withColumn("position", F.row_number().over(Window.partitionBy(by).orderBy(*order)))
    return ranked.filter(F.col("position") <= n)


def latest_per_type(results: DataFrame, order: list[Column], by: str = "type") -> DataFrame:
    return recent_n(results, order, 1, by).drop("position")


def dedup_windows(results: DataFrame, order: str | None = None) -> DataFrame:
    """One row per (kind, window start, user): repeats of a window result are dropped.

    ``order`` names a column (arrival number or time) whose smallest value wins on a stored table;
    without it any of the repeats is kept.  On a stream the first to arrive wins; give the input a
    watermark on ``ts``, and keys are forgotten once it has passed.
    """
    keyed = results.withColumn("__user", F.coalesce("user_id", F.lit("")))
    keys = ["kind", "window_start_ms", "__user"]
    if results.isStreaming:
        return keyed.dropDuplicatesWithinWatermark(keys).drop("__user")
    if order is None:
        return keyed.dropDuplicates(keys).drop("__user")
    # an aggregate rather than a ranking: repeats are folded before the shuffle
    first = keyed.groupBy(*keys).agg(F.min_by(F.struct(*results.columns), order).alias("r"))
    return first.select("r.*")


def recent_span(results: DataFrame) -> DataFrame:
    """First start and last end of the windows of each kind."""
    return results.groupBy("kind").agg(F.min("window_start_ms").alias("start_ms"), F.max("window_end_ms").alias("end_ms"))


def concurrency(intervals: DataFrame, start: str = "window_start_ms", end: str = "window_end_ms",
                chunk: int = HOUR) -> DataFrame:
    """Number of open half-open intervals after every moment at which it changes.

    Changes are folded to one row per millisecond, then summed per chunk of time and inside the
    chunk; touching intervals do not overlap because a start and an end at one moment cancel.
    """
    changes = intervals.select(F.explode(F.array(
        F.struct(F.col(start).alias("at_ms"), F.lit(1).cast("bigint").alias("d")),
        F.struct(F.col(end).alias("at_ms"), F.lit(-1).cast("bigint").alias("d")))).alias("x"))
    net = changes.groupBy("x.at_ms").agg(F.sum("x.d").alias("open"))
    return running(net, "at_ms", {"open": "sum"}, chunk)


def max_concurrent(intervals: DataFrame, start: str = "window_start_ms", end: str = "window_end_ms") -> DataFrame:
    return concurrency(intervals, start, end).agg(F.coalesce(F.max("open"), F.lit(0)).alias("max_concurrent"))
