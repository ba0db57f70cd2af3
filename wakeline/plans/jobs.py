"""The four standing jobs: raw message streams in, one result stream per topic out.

A job only builds streaming DataFrames; ``launch`` gives each its sink and checkpoint.  Sources
are any frames with the layout of ``sources.messages``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from wakeline import schemas
from wakeline.functions.timecols import DEFAULT_DELAY, MINUTE, SECOND, with_watermark
from wakeline.operators import codec, joins, patterns, topk, windows
from wakeline.streaming import fanout
from wakeline.streaming.bursts import rapid_purchases_stream
from wakeline.streaming.run import start

# topics the jobs read (fixed values)
VIEWS_TOPIC = "events.page_views"
PURCHASES_TOPIC = "events.purchases"


def read_views(raw: DataFrame, delay: int = DEFAULT_DELAY, fallback: str | None = None,
               on_error: str = "fail") -> DataFrame:
    return with_watermark(codec.decode(raw, schemas.PAGE_VIEW, on_error, fallback=fallback), delay)


def read_purchases(raw: DataFrame, delay: int = DEFAULT_DELAY, fallback: str | None = None,
                   on_error: str = "fail") -> DataFrame:
    return with_watermark(codec.decode(raw, schemas.PURCHASE, on_error, fallback=fallback), delay)


def topk_job(raw_views: DataFrame, k: int = 10, size: int = 10 * SECOND) -> dict[str, DataFrame]:
    """Board of the most viewed products per window; messages without a time take that of the record."""
    return {"results.topk": topk.topk_stream(read_views(raw_views, fallback="timestamp"), k, size)}


def window_stats_job(raw_views: DataFrame, size: int = 10 * SECOND, long_size: int = 30 * SECOND,
                     gap: int = 30 * SECOND) -> dict[str, DataFrame]:
    """Tumbling and sliding counts over everything, sessions per user: one source, three results."""
    views = read_views(raw_views)
    return {
        "results.windows.tumbling": windows.as_window_results(windows.tumbling_counts(views, size), "tumbling"),
        "results.windows.sliding": windows.as_window_results(windows.sliding_counts(views, long_size, size), "sliding"),
        "results.windows.sessions": windows.as_window_results(windows.session_counts(views, gap), "session"),
    }


def launch_window_stats(raw_views: DataFrame, checkpoint: str, folder: str, size: int = 10 * SECOND, long_size: int = 30 * SECOND,
                        gap: int = 30 * SECOND, **kwargs) -> StreamingQuery:
    """``window_stats_job`` as one query that reads and parses its source once, with a Parquet folder per result topic."""
    topics = {"tumbling": "results.windows.tumbling", "sliding": "results.windows.sliding", "session": "results.windows.sessions"}
    sink = fanout.route({kind: f"{folder}/{topic}" for kind, topic in topics.items()})
    return start(fanout.window_stats(read_views(raw_views), size, long_size, gap), sink, checkpoint, **kwargs)


def join_job(raw_views: DataFrame, raw_purchases: DataFrame, before: int = 30 * SECOND,
             after: int = 5 * MINUTE, salts: int = 1) -> dict[str, DataFrame]:
    """Purchases matched to the views of the same user around them."""
    return {"results.joins": joins.interval_join(read_views(raw_views), read_purchases(raw_purchases),
                                                 before, after, salts)}


def fraud_job(raw_purchases: DataFrame, min_times: int = 3, within: int = 10 * SECOND,
              immediate: bool = False) -> dict[str, DataFrame]:
    """Alerts on bursts of purchases; ``immediate`` does not wait for the time cell to close."""
    find = rapid_purchases_stream if immediate else patterns.rapid_purchases
    return {"results.fraud": find(read_purchases(raw_purchases), min_times, within)}


def launch(results: dict[str, DataFrame], sink: str, checkpoints: str, folder: str | None = None,
           **kwargs) -> list[StreamingQuery]:
    """Start every result stream: to its Kafka topic, or to a sub-folder of ``folder`` named like it.

    Each has its own state and checkpoint, so one can fail and restart without the others.
    """
    return [start(df, sink, f"{checkpoints}/{topic}", topic if sink == "kafka" else f"{folder}/{topic}", **kwargs)
            for topic, df in results.items()]
