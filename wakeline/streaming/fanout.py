"""Several windowed results from one read of a source, in one query with one state store.

Each event is tagged once for every window it falls into and once for its user's session.  A fixed window is
a session too: its events are keyed by its start and each holds it open until its end.  So one session
aggregation serves all tags, and a sink routes its rows by tag.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from wakeline.functions.timecols import SECOND, floor_to, ms


def _tag(kind: str, key: Column, start: Column, gap: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("user_id"), start.cast("bigint").alias("start"), gap.cast("bigint").alias("gap"))


def window_stats(views: DataFrame, size: int = 10 * SECOND, long_size: int = 30 * SECOND, gap: int = 30 * SECOND) -> DataFrame:
    """Tumbling counts of ``size``, sliding counts of ``long_size`` every ``size``, sessions per user: rows of ``windows.
    as_window_results``.  ``long_size`` is a multiple of ``size``; ``views`` has a watermark on ``ts``.

    With partial merging of sessions (``session.DEFAULTS``) a window costs one row per task before the shuffle.
    """
    t = ms()
    pane = floor_to(t, size)
    nobody, none = F.lit(None), F.lit(None)
    tags = [_tag("tumbling", nobody, pane, pane + size - t), _tag("session", F.col("user_id"), none, F.lit(gap))]
    tags += [_tag("sliding", nobody, pane - k * size, pane - k * size + long_size - t) for k in range(long_size // size)]
    tagged = views.filter(F.col("ts").isNotNull()).select("ts", F.inline(F.array(*tags)))
    # sessions of null users are one user's, as in ``windows.session_counts``
    held = F.session_window("ts", F.make_interval(secs=F.col("gap") / F.lit(1000).cast("decimal(18,6)")))
    counted = tagged.groupBy("kind", "user_id", "start", held.alias("w")).agg(F.count(F.lit(1)).alias("count"))
    return counted.select("kind", F.coalesce("start", ms(F.col("w.start"))).alias("window_start_ms"), ms(F.col("w.end")).alias("window_end_ms"),
                          "count", "user_id")


def route(folders: dict[str, str], by: str = "kind") -> Callable[[DataFrame, int], None]:
    """A sink that writes the rows of each value of ``by`` to a folder of its own, ``batch_id=<n>`` within it; a
    batch that runs again writes over its own rows, so every result is there once.  Rows of other values go nowhere."""
    def work(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # else each sink would run the query again
        for value, folder in folders.items():
            batch.filter(F.col(by) == value).write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")
        batch.unpersist()

    return work
