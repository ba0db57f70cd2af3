"""Streaming runs over the stored ``events`` table, checked like the stored-table queries.

Each reads the table as a file stream, works off what there is, then takes one flush event of a far
later time, and returns what reached the exactly-once Parquet sink.  The flush moves the watermark
past every window of the table, so the result is that of the whole table.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from wakeline.functions.timecols import DAY, HOUR, with_watermark
from wakeline.operators import joins, patterns, stages, topk, windows
from wakeline.plans.queries import query
from wakeline.session import DEFAULTS, shared_dir
from wakeline.sources import activity as src
from wakeline.streaming import accounts, concurrency, fanout, late_sessions, movement, refiring
from wakeline.streaming.bursts import rapid_purchases_stream
from wakeline.streaming.run import AVAILABLE_NOW, finish, start

#: After every event of the table; the windows the flush events themselves fall into stay open.
FLUSH_TIME = datetime(2200, 1, 1)


#: A tenth of the events of a fed stream arrive that much later than they happened.
LATE = 6 * HOUR
PIECES = 6


def _stream_settings(spark: SparkSession) -> None:
    for key, value in DEFAULTS.items():
        if key.startswith("spark.sql.streaming."):
            spark.conf.set(key, value)


def _flush_rows(spark: SparkSession) -> DataFrame:
    # users of their own, so that the two meet neither each other nor anyone in the table
    return spark.createDataFrame([(-1, FLUSH_TIME, -1, "view", None, None), (-2, FLUSH_TIME, -2, "purchase", None, None)],
                                 src.EVENTS).coalesce(1)


def _feed(spark: SparkSession, sf_dir: str, folder: str, start_query: Callable[[DataFrame], StreamingQuery]) -> None:
    """Run a query over the page views in ``PIECES`` micro-batches by time of arrival, then over the flush.

    A piece is a range of arrival times, appended to a folder that the query reads; the query goes on from its
    checkpoint each time.  Event ids that end in 0 arrive ``LATE``; the watermark allows for them.
    """
    _stream_settings(spark)
    events = spark.read.schema(src.EVENTS).parquet(f"{sf_dir}/events.parquet")
    at = F.unix_millis(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(at), F.max(at)).first()
    arrival = at + F.when(F.col("event_id") % 10 == 0, LATE).otherwise(0)
    piece = F.least(F.lit(PIECES - 1), F.floor((arrival - (low or 0)) * PIECES / ((high or 0) - (low or 0) + 1)))
    spark.createDataFrame([], src.EVENTS).write.parquet(f"{folder}/in/events.parquet")
    for k in range(PIECES + 1):
        rows = events.filter(piece == k) if k < PIECES else _flush_rows(spark)
        rows.write.mode("append").parquet(f"{folder}/in/events.parquet")
        finish(start_query(with_watermark(src.page_views(spark, f"{folder}/in", streaming=True), HOUR + LATE)))


def _run(spark: SparkSession, sf_dir: str, label: str, build: Callable[..., DataFrame],
         sink: Callable[[str], Callable[[DataFrame, int], None]] | None = None, reads: tuple = (src.page_views, src.purchases)) -> DataFrame:
    """Run ``build(views, purchases)``, or what ``reads`` names, over the table, then go on from its checkpoint with the flush.

    ``sink`` makes a sink for the folder whose sub-folders are to be read, instead of one Parquet table.
    """
    folder = shared_dir(spark, label)
    _stream_settings(spark)
    flush_dir = f"{folder}/flush"
    flush_table = f"{flush_dir}/events.parquet"
    spark.createDataFrame([], src.EVENTS).write.parquet(flush_table)

    def source(read: Callable[..., DataFrame]) -> DataFrame:
        both = read(spark, sf_dir, streaming=True).unionByName(read(spark, flush_dir, streaming=True))
        return with_watermark(both, HOUR)

    df = build(*[partial(source, read) for read in reads])

    def work_off() -> None:
        finish(start(df, sink(f"{folder}/out") if sink else "parquet", f"{folder}/checkpoint", None if sink else f"{folder}/out",
                     trigger=AVAILABLE_NOW))

    work_off()
    _flush_rows(spark).write.mode("append").parquet(flush_table)
    work_off()
    out = spark.read.schema(df.schema)
    return out.option("recursiveFileLookup", "true").parquet(f"{folder}/out") if sink else out.parquet(f"{folder}/out")


@query
def stream_tumbling_count(spark, sf_dir):
    return _run(spark, sf_dir, "tumbling", lambda views, purchases: windows.tumbling_counts(views(), HOUR))


@query
def stream_sliding_count(spark, sf_dir):
    return _run(spark, sf_dir, "sliding", lambda views, purchases: windows.sliding_counts(views(), 3 * HOUR, HOUR))


@query
def stream_session_count(spark, sf_dir):
    return _run(spark, sf_dir, "session", lambda views, purchases: windows.session_counts(views(), 6 * HOUR))


@query
def stream_topk_products(spark, sf_dir):
    return _run(spark, sf_dir, "topk", lambda views, purchases: topk.topk_products(views(), 10, DAY))


@query
def stream_interval_join(spark, sf_dir):
    return _run(spark, sf_dir, "join", lambda views, purchases: joins.interval_join(views(), purchases(), HOUR, 6 * HOUR))


@query
def stream_rapid_purchases(spark, sf_dir):
    return _run(spark, sf_dir, "bursts", lambda views, purchases: patterns.rapid_purchases(purchases(), 3, DAY))


@query
def stream_rapid_purchases_timers(spark, sf_dir):
    return _run(spark, sf_dir, "timers", lambda views, purchases: rapid_purchases_stream(purchases(), 3, DAY))


@query
def stream_rapid_purchase_staged(spark, sf_dir):
    return _run(spark, sf_dir, "staged", lambda views, purchases: stages.staged_purchases(
        purchases(), F.col("amount_usd") < 20, F.col("amount_usd") >= 10, 2, DAY))


@query
def stream_window_stats(spark, sf_dir):
    """Three results of one query that reads the table once, from a folder each."""
    return _run(spark, sf_dir, "stats", lambda views, purchases: fanout.window_stats(views(), HOUR, 3 * HOUR, 6 * HOUR),
                sink=lambda out: fanout.route({kind: f"{out}/{kind}" for kind in ("tumbling", "sliding", "session")}))


@query
def stream_allowed_lateness(spark, sf_dir):
    """Windows that fire again for late rows: the count at the first and the last firing."""
    folder = shared_dir(spark, "lateness")
    _feed(spark, sf_dir, folder, lambda views: start(
        refiring.refiring_counts(views, HOUR), refiring.upsert(f"{folder}/table", HOUR), f"{folder}/checkpoint",
        output_mode="update", trigger=AVAILABLE_NOW))
    fired = refiring.firings(spark, f"{folder}/table", delay=HOUR)
    return fired.groupBy("window_start_ms", "window_end_ms").agg(
        F.min_by("count", "firing").alias("first_count"), F.max_by("count", "firing").alias("count"), F.count(F.lit(1)).alias("firings"))


@query
def stream_session_lateness(spark, sf_dir):
    """Sessions after late rows have changed, joined or made some of them."""
    folder = shared_dir(spark, "late-sessions")
    _feed(spark, sf_dir, folder, lambda views: start(
        late_sessions.session_changes(views, 6 * HOUR, LATE), "parquet", f"{folder}/checkpoint", f"{folder}/out", trigger=AVAILABLE_NOW))
    changes = spark.read.parquet(f"{folder}/out")
    return late_sessions.standing(changes).select("window_start_ms", "window_end_ms", "user_id", "count")


@query
def stream_topk_approx(spark, sf_dir):
    return _run(spark, sf_dir, "approx", lambda views, purchases: topk.topk_approx_stream(views(), 10, DAY))


@query
def stream_funnel(spark, sf_dir):
    return joins.funnel_totals(_run(spark, sf_dir, "funnel", lambda views, purchases: joins.funnel_stream(views(), purchases(), 6 * HOUR)).filter(
        F.col("view_ts") < int(FLUSH_TIME.replace(tzinfo=timezone.utc).timestamp()) * 1000))


@query
def stream_concurrent_sessions(spark, sf_dir):
    return _run(spark, sf_dir, "concurrency", lambda views, purchases: concurrency.concurrent_sessions(views(), 6 * HOUR, HOUR))


@query
def stream_rank_movement(spark, sf_dir):
    return _run(spark, sf_dir, "movement", lambda views, purchases: movement.rank_movement_stream(views(), 10, DAY, chunk=7 * DAY))


@query
def stream_new_account_burst(spark, sf_dir):
    return _run(spark, sf_dir, "accounts", lambda activity, purchases: accounts.new_account_bursts_stream(
        rapid_purchases_stream(purchases(), 3, DAY, timed=True), activity(), 7 * DAY), reads=(src.activity, src.purchases))
