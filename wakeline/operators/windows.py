"""Event-time windowed aggregation: tumbling, sliding and session windows."""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window, functions as F

from wakeline.functions.timecols import SECOND, bounds, duration, floor_to, ms

# measures are SQL expressions, summed per group
COUNT = {"count": "1L"}
# wide enough that summing amounts cuts nothing off
AMOUNT = "cast(amount_usd AS decimal(28,9))"


def stream_window(size: int, slide: int | None = None) -> Column:
    return F.window("ts", duration(size), duration(slide)) if slide else F.window("ts", duration(size))


def window_sums(df: DataFrame, measures: dict[str, str], keys: tuple[str, ...] = (),
                size: int = 10 * SECOND, slide: int | None = None) -> DataFrame:
    """Sum each measure per key and window ``[start, end)``; empty windows give no row.

    The sums are folded on the map side, so a hot key or window costs one row per map task.
    A stored table is folded once per pane (the common divisor of size and slide) and the panes
    are then spread over their windows, so rows are never multiplied by size / slide.
    """
    if df.isStreaming:
        grouped = (df.select(stream_window(size, slide).alias("w"), *keys,
                             *[F.expr(e).alias(n) for n, e in measures.items()])
                   .groupBy("w", *keys).agg(*[F.sum(n).alias(n) for n in measures]))
        return grouped.select(*bounds("w"), *keys, *measures)
    step = slide or size
    pane = gcd(size, step)
    start = "window_start_ms"
    rows = df.select(floor_to(ms(), pane).alias(start), *keys, *[F.expr(e).alias(n) for n, e in measures.items()])
    sums = rows.filter(F.col(start).isNotNull()).groupBy(start, *keys).agg(*[F.sum(n).alias(n) for n in measures])
    if step != size:
        last = floor_to(F.col(start), step)
        covering = -(-size // step)
        step_col = F.lit(step).cast("bigint")
        spread = sums.select(
            F.col(start).alias("__pane"),
            F.explode(F.sequence(last - (covering - 1) * step_col, last, step_col)).alias(start), *keys, *measures)
        if size % step:
            spread = spread.filter(F.col(start) + size > F.col("__pane"))
        sums = spread.groupBy(start, *keys).agg(*[F.sum(n).alias(n) for n in measures])
    return sums.select(start, (F.col(start) + size).alias("window_end_ms"), *keys, *measures)


def window_aggregate(df: DataFrame, aggregates: list[Column], keys: tuple[str, ...] = (),
                     size: int = 10 * SECOND, slide: int | None = None) -> DataFrame:
    """Any aggregates per key and window, with the bounds of the window; for what is not a sum.

    ``aggregates`` are aliased columns; those Spark can fold before the shuffle it does.
    """
    grouped = df.groupBy(stream_window(size, slide).alias("w"), *keys).agg(*aggregates)
    return grouped.select(*bounds("w"), *[c for c in grouped.columns if c != "w"])


def tumbling_counts(df: DataFrame, size: int = 10 * SECOND, keys: tuple[str, ...] = ()) -> DataFrame:
    """Events per window (and key)."""
    return window_sums(df, COUNT, keys, size)


def sliding_counts(df: DataFrame, size: int = 30 * SECOND, slide: int = 10 * SECOND,
                   keys: tuple[str, ...] = ()) -> DataFrame:
    """Events per overlapping window; each event counts in size / slide windows."""
    return window_sums(df, COUNT, keys, size, slide)


def counts_by_product(df: DataFrame, size: int = 10 * SECOND, slide: int | None = None) -> DataFrame:
    return window_sums(df, COUNT, ("product_id",), size, slide)


def salted_counts(df: DataFrame, size: int = 10 * SECOND, key: str = "product_id",
                  salt_on: str = "user_id", salts: int = 16) -> DataFrame:
    """Two-stage count: per (window, key, salt), then per (window, key).

    On a stream this spreads the state and the updates of a hot key over ``salts`` state rows
    in different partitions; the result equals the plain count.
    """
    salt = F.pmod(F.xxhash64(salt_on), F.lit(salts)).alias("salt")
    if df.isStreaming:
        partial = df.groupBy(stream_window(size).alias("w"), key, salt).agg(F.count(F.lit(1)).alias("n"))
        return partial.groupBy("w", key).agg(F.sum("n").alias("count")).select(*bounds("w"), key, "count")
    start = floor_to(ms(), size).alias("window_start_ms")
    partial = df.filter(F.col("ts").isNotNull()).groupBy(start, key, salt).agg(F.count(F.lit(1)).alias("n"))
    total = partial.groupBy("window_start_ms", key).agg(F.sum("n").alias("count"))
    return total.select("window_start_ms", (F.col("window_start_ms") + size).alias("window_end_ms"), key, "count")


def gmv(purchases: DataFrame, size: int = 60 * SECOND, slide: int | None = None) -> DataFrame:
    """Revenue and number of purchases per window; amounts are summed exactly to nine decimals."""
    measures = {"gmv": AMOUNT, **COUNT}
    return window_sums(purchases, measures, (), size, slide).select(
        "window_start_ms", "window_end_ms", F.col("gmv").cast("double").alias("gmv_usd"),
        F.col("count").alias("purchases"))


def _session_cells(df: DataFrame, gap: int, keys: list[str]) -> DataFrame:
    """Fold events to one row per (key, cell of ``gap`` ms).

    Two events of one cell are less than a gap apart, so a cell never spans two sessions.  A hot
    user is thus reduced on the map side to at most one row per gap of elapsed time.
    """
    return (df.select("user_id", *[k for k in keys if k != "user_id"], ms().alias("t"))
            .filter(F.col("t").isNotNull())
            .groupBy(*keys, floor_to(F.col("t"), gap).alias("cell"))
            .agg(F.min("t").alias("first_ms"), F.max("t").alias("last_ms"), F.count(F.lit(1)).alias("n")))


def _number_sessions(cells: DataFrame, gap: int) -> DataFrame:
    """Add ``session``, the start of the session each cell belongs to."""
    by_user = Window.partitionBy("user_id").orderBy("cell")
    opens = F.col("first_ms") - F.lag("last_ms").over(by_user) > gap
    # null lag: the first cell of a user also opens
    start = F.when(F.coalesce(opens, F.lit(True)), F.col("first_ms"))
    return cells.withColumn("session", F.max(start).over(by_user))


def session_counts(df: DataFrame, gap: int = 30 * SECOND) -> DataFrame:
    """Sessions per user, ``[first event, last event + gap)``; events exactly a gap apart merge."""
    if df.isStreaming:
        return (df.groupBy("user_id", F.session_window("ts", duration(gap)).alias("w"))
                .agg(F.count(F.lit(1)).alias("count"))
                .select(*bounds("w"), "user_id", "count"))
    cells = _number_sessions(_session_cells(df, gap, ["user_id"]), gap)
    return (cells.groupBy("user_id", "session")
            .agg(F.max("last_ms").alias("last_ms"), F.sum("n").alias("count"))
            .select(F.col("session").alias("window_start_ms"), (F.col("last_ms") + gap).alias("window_end_ms"),
                    "user_id", "count"))


def session_metrics(df: DataFrame, gap: int = 30 * SECOND) -> DataFrame:
    """Count, duration and distinct products of each session."""
    if df.isStreaming:
        closed = (df.groupBy("user_id", F.session_window("ts", duration(gap)).alias("w"))
                  .agg(F.count(F.lit(1)).alias("count"), F.size(F.collect_set("product_id")).cast("bigint").alias("products")))
        return closed.select(*bounds("w"), "user_id", "count",
                             (ms(F.col("w.end")) - ms(F.col("w.start")) - gap).alias("duration_ms"), "products")
    by_product = _session_cells(df, gap, ["user_id", "product_id"])
    starts = _number_sessions(_session_cells(df, gap, ["user_id"]), gap).select("user_id", "cell", "session")
    per_product = (by_product.join(starts, ["user_id", "cell"])
                   .groupBy("user_id", "session", "product_id")
                   .agg(F.sum("n").alias("n"), F.max("last_ms").alias("last_ms")))
    return (per_product.groupBy("user_id", "session")
            .agg(F.sum("n").alias("count"), F.max("last_ms").alias("last_ms"), F.count("product_id").alias("products"))
            .select(F.col("session").alias("window_start_ms"), (F.col("last_ms") + gap).alias("window_end_ms"),
                    "user_id", "count", (F.col("last_ms") - F.col("session")).alias("duration_ms"), "products"))


def as_window_results(df: DataFrame, kind: str) -> DataFrame:
    """The common result layout; ``user_id`` is null except for sessions."""
    user = F.col("user_id") if "user_id" in df.columns else F.lit(None).cast("string").alias("user_id")
    return df.select(F.lit(kind).alias("kind"), "window_start_ms", "window_end_ms", "count", user)


def dashboard_counters(events: DataFrame, late: Column, flagged: Column) -> DataFrame:
    """Running totals of the event log: all, late, purchases, flagged purchases.

    On a stream run it in ``update`` or ``complete`` mode: one row, refreshed per micro-batch.
    """
    is_purchase = F.col("event_type") == "purchase"
    return events.agg(F.count(F.lit(1)).alias("total"), F.count_if(late).alias("late"),
                      F.count_if(is_purchase).alias("purchases"),
                      F.count_if(is_purchase & flagged).alias("flagged"))
