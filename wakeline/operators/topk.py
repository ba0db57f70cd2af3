"""Leaderboards: the k most viewed products of each window, and measures on the board."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wakeline.functions.running import running
from wakeline.functions.timecols import DAY, SECOND, bounds, floor_to, ms
from wakeline.operators.windows import counts_by_product, stream_window

BUCKETS = 256


def rank_counts(counts: DataFrame, k: int = 10) -> DataFrame:
    """Rank ``(window, product, count)`` rows and keep the first ``k`` per window.

    Ties go to the smaller product_id.  Catalyst turns the rank filter into a group limit, so
    each map task forwards at most ``k`` rows per window, however many products there are.
    """
    order = Window.partitionBy("window_start_ms").orderBy(F.desc("count"), "product_id")
    return (counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("window_start_ms", "window_end_ms", "rank", "product_id", "count"))


def _slice(column: str, k: int):
    return F.slice(F.sort_array(column), 1, k)


def board_stream(views: DataFrame, k: int = 10, size: int = 10 * SECOND, slide: int | None = None,
                 buckets: int = BUCKETS) -> DataFrame:
    """(w, best) of each closed window: the window and its ``k`` best entries (neg, product_id).

    Three chained aggregations: count per product, best ``k`` of each product bucket, best ``k``
    of the window.  No group holds more than the products of one bucket, or buckets * k rows.
    """
    counts = (views.groupBy(stream_window(size, slide).alias("w"), "product_id")
              .agg(F.count(F.lit(1)).alias("n")))
    entry = F.struct((-F.col("n")).alias("neg"), "product_id")
    partial = (counts.groupBy("w", F.pmod(F.xxhash64("product_id"), F.lit(buckets)).alias("bucket"))
               .agg(_slice(F.collect_list(entry), k).alias("best")))
    return partial.groupBy("w").agg(_slice(F.flatten(F.collect_list("best")), k).alias("best"))


def topk_stream(views: DataFrame, k: int = 10, size: int = 10 * SECOND, slide: int | None = None,
                buckets: int = BUCKETS) -> DataFrame:
    """Boards of a streaming input as a streaming DataFrame (append: once per closed window)."""
    return board_stream(views, k, size, slide, buckets).select(*bounds("w"), F.transform(
        "best", lambda e: F.struct(e["product_id"].alias("product_id"), (-e["neg"]).alias("count"))).alias("top"))


def topk_products(views: DataFrame, k: int = 10, size: int = 10 * SECOND,
                  slide: int | None = None) -> DataFrame:
    """Top ``k`` products per window, one row per rank."""
    if views.isStreaming:
        boards = topk_stream(views, k, size, slide)
        return (boards.select("window_start_ms", "window_end_ms", F.posexplode("top").alias("pos", "e"))
                .select("window_start_ms", "window_end_ms", (F.col("pos") + 1).alias("rank"),
                        F.col("e.product_id").alias("product_id"), F.col("e.count").alias("count")))
    return rank_counts(counts_by_product(views, size, slide), k)


def nest_board(board: DataFrame) -> DataFrame:
    """One row per window with the ranked entries in ``top`` (at most k per window)."""
    entries = F.sort_array(F.collect_list(F.struct("rank", "product_id", "count")))
    return (board.groupBy("window_start_ms", "window_end_ms").agg(entries.alias("e"))
            .select("window_start_ms", "window_end_ms", F.transform(
                "e", lambda x: F.struct(x["product_id"].alias("product_id"), x["count"].alias("count"))).alias("top")))


def topk_sql(views: DataFrame, k: int = 10, size: int = DAY) -> DataFrame:
    """The same board written as SQL with ROW_NUMBER."""
    return views.sparkSession.sql(
        """
        SELECT window_start_ms, window_start_ms + {size} AS window_end_ms, rank, product_id, count
        FROM (
          SELECT window_start_ms, product_id, count,
                 row_number() OVER (PARTITION BY window_start_ms ORDER BY count DESC, product_id) AS rank
          FROM (
            SELECT unix_millis(ts) - pmod(unix_millis(ts), {size}) AS window_start_ms, product_id, count(*) AS count
            FROM {views} WHERE ts IS NOT NULL GROUP BY ALL
          )
        )
        WHERE rank <= {k}
        """, views=views, size=size, k=k)


def topk_two_level(views: DataFrame, k: int = 10, size: int = 10 * SECOND, buckets: int = BUCKETS) -> DataFrame:
    """Best ``k`` of each product bucket, then best ``k`` of the window; equals the plain board.

    The first ranking is spread over (window, bucket), so one crowded window is not one task.
    """
    counts = counts_by_product(views, size)
    bucket = F.pmod(F.xxhash64("product_id"), F.lit(buckets))
    local = Window.partitionBy("window_start_ms", bucket).orderBy(F.desc("count"), "product_id")
    kept = counts.withColumn("__r", F.row_number().over(local)).filter(F.col("__r") <= k).drop("__r")
    return rank_counts(kept, k)


def sketch_error(tracked: int, total: Column) -> Column:
    """Bound of a sketch's error: 3.5 times the total over its number of slots, the power of two above 4 / 3 ``tracked``."""
    slots = 1 << (4 * tracked // 3).bit_length()
    return F.floor(total * 3.5 / slots).cast("bigint")


def topk_approx_stream(views: DataFrame, k: int = 10, size: int = 10 * SECOND, tracked: int = 10_000) -> DataFrame:
    """Heavy hitters on a stream: one sketch per window is all the state, whatever the number of products.

    A hot window costs one sketch per task before the shuffle.  ``count`` exceeds the true count by at most ``error_max``; a product that is not among the
    ``tracked`` has at most ``error_max`` events.  Ties go to the smaller product id.
    """
    sketched = views.groupBy(stream_window(size).alias("w")).agg(
        F.expr(f"approx_top_k(product_id, {tracked}, {tracked})").alias("best"), F.count(F.lit(1)).alias("all"))
    ordered = F.slice(F.sort_array(F.transform("best", lambda x: F.struct((-x["count"]).alias("c"), x["item"].alias("p")))), 1, k)
    return sketched.select(*bounds("w"), sketch_error(tracked, F.col("all")).alias("error_max"), F.posexplode(ordered).alias("i", "e")).select(
        "window_start_ms", "window_end_ms", (F.col("i") + 1).alias("rank"), F.col("e.p").alias("product_id"),
        (-F.col("e.c")).alias("count"), "error_max")


def topk_approx(views: DataFrame, k: int = 10, size: int = 10 * SECOND, tracked: int = 10_000) -> DataFrame:
    """Heavy hitters: a bounded sketch per window names up to ``tracked`` candidates, which are then
    counted and ranked exactly (stored tables).

    ``unlisted_max`` is the number of events of products that are no candidates: no such product
    has a larger count.  It is 0, and the board exact, while a window has at most ``tracked`` products.
    """
    rows = views.filter(F.col("ts").isNotNull()).select(floor_to(ms(), size).alias("window_start_ms"), "product_id")
    sketch = rows.groupBy("window_start_ms").agg(
        F.expr(f"approx_top_k(product_id, {tracked}, {tracked})").alias("best"), F.count(F.lit(1)).alias("all"))
    candidates = sketch.select(F.col("window_start_ms").alias("w"), F.explode("best.item").alias("item"))
    listed = (rows.join(candidates, (F.col("window_start_ms") == F.col("w")) & F.col("product_id").eqNullSafe(F.col("item")),
                        "left_semi")
              .groupBy("window_start_ms", "product_id").agg(F.count(F.lit(1)).alias("count"))
              .withColumn("window_end_ms", F.col("window_start_ms") + size))
    known = listed.groupBy("window_start_ms").agg(F.sum("count").alias("known"))
    rest = (sketch.select("window_start_ms", "all").join(known, "window_start_ms")
            .select("window_start_ms", (F.col("all") - F.col("known")).alias("unlisted_max")))
    return rank_counts(listed, k).join(rest, "window_start_ms")


def rank_movement(board: DataFrame, chunk: int = 64 * DAY) -> DataFrame:
    """Places gained since the previous board; null for products that were not on it.

    The previous board is that of the previous window that has one, not the previous window in
    which the product appeared.
    """
    windows = board.select("window_start_ms").distinct()
    previous = running(windows.withColumn("prev_ms", F.col("window_start_ms")), "window_start_ms",
                       {"prev_ms": "max"}, chunk, inclusive=False)
    before = board.select(F.col("window_start_ms").alias("prev_ms"), "product_id", F.col("rank").alias("prev_rank"))
    return (board.join(previous, "window_start_ms").join(before, ["prev_ms", "product_id"], "left")
            .select("window_start_ms", "rank", "product_id", "prev_rank",
                    (F.col("prev_rank") - F.col("rank")).alias("movement")))


def share_of_max(counts: DataFrame) -> DataFrame:
    """Each count relative to the largest count of its window."""
    best = counts.groupBy("window_start_ms").agg(F.max("count").alias("leader"))
    share = F.col("count").cast("double") / F.greatest(F.col("leader"), F.lit(1))
    return counts.join(best, "window_start_ms").select(
        "window_start_ms", "window_end_ms", "product_id", "count", share.alias("share"))


def key_skew(events: DataFrame, key: str = "product_id") -> DataFrame:
    """Events per key, with the share of all events and the ratio to the busiest key."""
    counts = events.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
    totals = counts.agg(F.struct(F.sum("count").alias("all"), F.max("count").alias("top"))).scalar()
    n = F.col("count").cast("double")
    return counts.select(key, "count", (n / totals["all"]).alias("share"), (n / totals["top"]).alias("heat"))


def key_skew_latest(events: DataFrame, key: str = "product_id", size: int = 10 * SECOND) -> DataFrame:
    """``key_skew`` of the newest window that has events."""
    start = floor_to(ms(), size)
    return key_skew(events.filter(start == events.agg(F.max(start)).scalar()), key)
