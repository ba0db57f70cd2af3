"""Every operator on the stored ``events`` table, with parameters that suit its sparse events."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wakeline import schemas
from wakeline.functions.timecols import DAY, HOUR
from wakeline.operators import codec, custom, joins, lateness, patterns, results, stages, topk, windows
from wakeline.plans import arrivals
from wakeline.sources import activity as src

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


# --- records ----------------------------------------------------------------------------------

def _as_messages(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.select(F.to_json(F.struct(*columns)).alias("value"), F.col("ts").alias("timestamp"))


@query
def decode_page_views(spark, sf_dir):
    views = src.page_views(spark, sf_dir).withColumn("late", F.col("event_id") % arrivals.LATE_EVERY == 0)
    messages = _as_messages(views, "user_id", "product_id", "ts_ms", "late", "event_id")
    return codec.decode(messages, schemas.PAGE_VIEW).drop("ts")


@query
def decode_purchases(spark, sf_dir):
    bought = src.purchases(spark, sf_dir).withColumn("fraud_hint", F.col("amount_usd") > 200)
    messages = _as_messages(bought, "user_id", "product_id", F.col("amount_usd").cast("string").alias("amount_usd"),
                            F.col("ts_ms").cast("string").alias("ts_ms"), "fraud_hint", "event_id")
    return codec.decode(messages, schemas.PURCHASE).drop("ts")


@query
def page_views_in_range(spark, sf_dir):
    views = src.page_views(spark, sf_dir, start="2024-01-10", end="2024-01-20")
    return views.select("event_id", "user_id", "product_id", "ts_ms")


@query
def event_time_fallback(spark, sf_dir):
    views = src.page_views(spark, sf_dir)
    # null fields are left out of the text, so these messages have no ts_ms
    sent = F.when(F.col("event_id") % 10 != 0, F.col("ts_ms")).alias("ts_ms")
    messages = _as_messages(views, "user_id", "product_id", sent)
    decoded = codec.decode(messages, schemas.PAGE_VIEW, fallback=F.col("timestamp"))
    return decoded.select("user_id", "product_id", "ts_ms", F.unix_millis("ts").alias("event_ms"))


@query
def encode_results(spark, sf_dir):
    return codec.encode(windows.as_window_results(session_count(spark, sf_dir), "session"))


def _window_results(spark, sf_dir) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        windows.as_window_results(tumbling_count(spark, sf_dir), "tumbling"),
        windows.as_window_results(sliding_count(spark, sf_dir), "sliding"),
        windows.as_window_results(session_count(spark, sf_dir), "session")])


def _topic(kind: Column) -> Column:
    return F.create_map(*[F.lit(x) for topic, name in schemas.RESULT_TOPICS.items() for x in (name, topic)])[kind]


@query
def results_union(spark, sf_dir):
    known = _window_results(spark, sf_dir)
    fields = F.struct(*schemas.WINDOW_RESULT.names)
    messages = known.select(_topic(F.col("kind")).alias("topic"), F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"))
    # the same messages under an unknown topic and cut short: none of them may come through
    unknown = messages.withColumn("topic", F.lit("results.other"))
    broken = messages.withColumn("value", F.expr("left(value, length(value) - 2)"))
    return codec.route(messages.unionByName(unknown).unionByName(broken),
                       schemas.RESULT_TOPICS, schemas.WINDOW_RESULT)


# --- windows ----------------------------------------------------------------------------------

@query
def tumbling_by_product(spark, sf_dir):
    return windows.counts_by_product(src.page_views(spark, sf_dir), DAY)


@query
def tumbling_by_product_salted(spark, sf_dir):
    return windows.salted_counts(src.page_views(spark, sf_dir), DAY)


@query
def tumbling_count(spark, sf_dir):
    return windows.tumbling_counts(src.page_views(spark, sf_dir), HOUR)


@query
def sliding_count(spark, sf_dir):
    return windows.sliding_counts(src.page_views(spark, sf_dir), 3 * HOUR, HOUR)


@query
def session_count(spark, sf_dir):
    return windows.session_counts(src.page_views(spark, sf_dir), 6 * HOUR)


@query
def session_metrics(spark, sf_dir):
    return windows.session_metrics(src.page_views(spark, sf_dir), 6 * HOUR)


@query
def gmv_per_window(spark, sf_dir):
    return windows.gmv(src.purchases(spark, sf_dir), HOUR)


@query
def gmv_sliding(spark, sf_dir):
    return windows.gmv(src.purchases(spark, sf_dir), 3 * HOUR, HOUR)


@query
def window_aggregate(spark, sf_dir):
    spread = [F.min("amount_usd").alias("smallest"), F.max("amount_usd").alias("largest"),
              F.count_distinct("user_id").alias("buyers")]
    return windows.window_aggregate(src.purchases(spark, sf_dir), spread, ("product_id",), 3 * DAY, DAY)


@query
def dashboard_counters(spark, sf_dir):
    events = src.activity(spark, sf_dir).filter(F.col("event_type").isin("view", "purchase"))
    return windows.dashboard_counters(events, F.col("event_id") % arrivals.LATE_EVERY == 0, F.col("amount_usd") > 200)


# --- leaderboards -----------------------------------------------------------------------------

@query
def topk_products(spark, sf_dir):
    return topk.topk_products(src.page_views(spark, sf_dir), 10, DAY)


@query
def topk_products_nested(spark, sf_dir):
    return codec.encode(topk.nest_board(topk_products(spark, sf_dir)))


@query
def topk_sql(spark, sf_dir):
    return topk.topk_sql(src.page_views(spark, sf_dir), 10, DAY)


@query
def topk_sliding(spark, sf_dir):
    return topk.topk_products(src.page_views(spark, sf_dir), 10, 3 * DAY, DAY)


@query
def topk_approx(spark, sf_dir):
    return topk.topk_approx(src.page_views(spark, sf_dir), 10, DAY)


@query
def topk_two_level(spark, sf_dir):
    return topk.topk_two_level(src.page_views(spark, sf_dir), 10, DAY)


@query
def rank_movement(spark, sf_dir):
    return topk.rank_movement(topk_products(spark, sf_dir))


@query
def share_of_max(spark, sf_dir):
    return topk.share_of_max(tumbling_by_product(spark, sf_dir))


@query
def key_skew(spark, sf_dir):
    return topk.key_skew(src.page_views(spark, sf_dir))


@query
def key_skew_latest(spark, sf_dir):
    return topk.key_skew_latest(src.page_views(spark, sf_dir), size=DAY)


# --- joins ------------------------------------------------------------------------------------

@query
def interval_join(spark, sf_dir):
    return joins.interval_join(src.page_views(spark, sf_dir), src.purchases(spark, sf_dir), HOUR, 6 * HOUR)


@query
def same_product_conversion(spark, sf_dir):
    return joins.conversion(src.page_views(spark, sf_dir), src.purchases(spark, sf_dir), DAY, 3 * DAY)


@query
def same_product_conversion_latest(spark, sf_dir):
    return joins.latest_conversion(src.page_views(spark, sf_dir), src.purchases(spark, sf_dir), DAY, 3 * DAY, latest=12)


@query
def window_join(spark, sf_dir):
    return joins.window_join(src.page_views(spark, sf_dir), src.purchases(spark, sf_dir), 6 * HOUR)


@query
def funnel(spark, sf_dir):
    return joins.funnel(src.page_views(spark, sf_dir), src.purchases(spark, sf_dir), 6 * HOUR)


# --- patterns ---------------------------------------------------------------------------------

@query
def rapid_purchases(spark, sf_dir):
    return patterns.rapid_purchases(src.purchases(spark, sf_dir), 3, DAY)


@query
def rapid_purchase_filtered(spark, sf_dir):
    return patterns.rapid_purchases(src.purchases(spark, sf_dir), 3, DAY, where=F.col("amount_usd") >= 20)


@query
def custom_quantile(spark, sf_dir):
    return custom.quantile_per_window(src.purchases(spark, sf_dir), 0.9, DAY)


@query
def rapid_purchase_staged(spark, sf_dir):
    """A small purchase, then two larger ones; those between the two amounts may be either."""
    return stages.staged_purchases(src.purchases(spark, sf_dir), F.col("amount_usd") < 20, F.col("amount_usd") >= 10, 2, DAY)


@query
def threshold_anomaly(spark, sf_dir):
    return patterns.threshold_anomaly(src.purchases(spark, sf_dir), 150, DAY)


@query
def new_account_burst(spark, sf_dir):
    return patterns.new_account_bursts(rapid_purchases(spark, sf_dir), src.activity(spark, sf_dir), 7 * DAY)


# --- lateness ---------------------------------------------------------------------------------

@query
def watermark_replay(spark, sf_dir):
    return lateness.replay_watermarks(arrivals.arrival_log(spark, sf_dir), HOUR).select(
        "event_id", "batch", F.unix_millis("ts").alias("event_ms"), "watermark_ms", "is_late", "lag_ms")


@query
def min_watermark(spark, sf_dir):
    return lateness.min_watermark(arrivals.arrival_log(spark, sf_dir), list(range(arrivals.PARTITIONS)), HOUR)


@query
def late_counts(spark, sf_dir):
    return lateness.late_counts(arrivals.arrival_log(spark, sf_dir), HOUR)


@query
def late_side_output(spark, sf_dir):
    return lateness.late_side_output(arrivals.arrival_log(spark, sf_dir), HOUR, HOUR).select(
        "event_id", "user_id", "product_id", "ts_ms", "window_end_ms", "watermark_ms")


@query
def late_dropped_windows(spark, sf_dir):
    return lateness.late_dropped_windows(arrivals.arrival_log(spark, sf_dir), HOUR, HOUR)


@query
def allowed_lateness(spark, sf_dir):
    return lateness.allowed_lateness(arrivals.arrival_log(spark, sf_dir), HOUR, HOUR, 2 * HOUR)


@query
def watermark_lag_bands(spark, sf_dir):
    return lateness.watermark_lag_bands(arrivals.arrival_log(spark, sf_dir), HOUR, 2 * HOUR, 4 * HOUR)


@query
def event_vs_arrival(spark, sf_dir):
    return lateness.event_vs_arrival(arrivals.arrival_log(spark, sf_dir), HOUR)


# --- result tables ----------------------------------------------------------------------------

def _results(spark, sf_dir) -> DataFrame:
    """The results of all six types as (type, result_ms, start_ms, user_id, payload), the payload as sent."""
    typed = {
        "topk": topk.nest_board(topk_products(spark, sf_dir)),
        "tumbling": windows.as_window_results(tumbling_count(spark, sf_dir), "tumbling"),
        "sliding": windows.as_window_results(sliding_count(spark, sf_dir), "sliding"),
        "session": windows.as_window_results(session_count(spark, sf_dir), "session"),
        "join": interval_join(spark, sf_dir),
        "fraud": rapid_purchases(spark, sf_dir),
    }
    times = {"join": ("purchase_ts", "view_ts"), "fraud": ("last_ts", "first_ts")}

    def row(kind: str, df: DataFrame) -> DataFrame:
        end, begin = times.get(kind, ("window_end_ms", "window_start_ms"))
        user = F.col("user_id") if "user_id" in df.columns else F.lit(None).cast("string")
        return df.select(F.lit(kind).alias("type"), F.col(end).alias("result_ms"), F.col(begin).alias("start_ms"),
                         user.alias("user_id"), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("payload"))

    return reduce(DataFrame.unionByName, [row(*item) for item in typed.items()])


def _newest() -> list[Column]:
    return [F.desc("result_ms"), F.desc("start_ms"), F.asc("user_id"), F.asc("payload")]


@query
def result_feed(spark, sf_dir):
    """All six result streams as messages of their topics, brought together by type."""
    sent = _results(spark, sf_dir).select(_topic(F.col("type")).alias("topic"), F.col("payload").alias("value"))
    return codec.relay(sent, schemas.RESULT_TOPICS)


@query
def latest_per_type(spark, sf_dir):
    return results.latest_per_type(_results(spark, sf_dir), _newest())


@query
def recent_n(spark, sf_dir):
    return results.recent_n(_results(spark, sf_dir), _newest(), 50)


@query
def dedup_windows(spark, sf_dir):
    """Every window result arrives twice with different counts; ``seq`` is the order of arrival."""
    once = _window_results(spark, sf_dir)
    again = once.withColumn("count", F.col("count") + 1).withColumn(
        "seq", F.when(F.col("window_start_ms") % (2 * HOUR) == 0, 1).otherwise(3).cast("bigint"))
    return results.dedup_windows(once.withColumn("seq", F.lit(2).cast("bigint")).unionByName(again), "seq")


@query
def recent_windows(spark, sf_dir):
    newest = [F.desc("window_start_ms"), F.asc("user_id")]
    return results.recent_n(results.dedup_windows(_window_results(spark, sf_dir)), newest, 30, by="kind")


@query
def recent_span(spark, sf_dir):
    return results.recent_span(_window_results(spark, sf_dir))


@query
def max_concurrent_sessions(spark, sf_dir):
    return results.max_concurrent(session_count(spark, sf_dir))
