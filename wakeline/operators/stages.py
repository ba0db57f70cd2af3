"""Two-stage patterns: an event of one kind, then several of another, of one user within a bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wakeline.functions.timecols import SECOND, floor_to, ms
from wakeline.operators.patterns import RANKS, cell_width, spread_over_cells
from wakeline.operators.windows import AMOUNT


def flags(first: Column, more: Column) -> list[Column]:
    """The two conditions as columns; unknown counts as no."""
    return [F.coalesce(first, F.lit(False)).alias("first"), F.coalesce(more, F.lit(False)).alias("more")]


def staged_purchases(purchases: DataFrame, first: Column, more: Column, min_more: int = 2, within: int = 10 * SECOND,
                     order: tuple[str, ...] = ("product_id", "amount_usd")) -> DataFrame:
    """One alert per event that meets ``first`` and later event of its user that meets ``more``, less than ``within``
    ms apart, with at least ``min_more`` events that meet ``more`` after the one and up to the other.

    An alert counts and sums the first event and all those; other events are skipped.  An event that
    meets both conditions may begin one alert and continue another, never both of one.  ``order`` ranks events
    of equal time; those equal in it and in both conditions are interchangeable.  With both conditions true this is
    ``patterns.rapid_purchases``.

    First events are ranked inside (user, time cell), and so is known of each later event which range of ranks it
    ends alerts for: one bound comes from the time, one from the count.  The pairs are formed in groups of
    ``RANKS`` first events, so the work follows the number of alerts and is spread over tasks.

    On a stream (with a watermark on ``ts``) alerts come when the watermark reaches their last event; see
    ``streaming.stages``.
    """
    if purchases.isStreaming:
        from wakeline.streaming.stages import staged_purchases_stream

        return staged_purchases_stream(purchases, first, more, min_more, within, order)
    ties = [f"o{i}" for i in range(len(order))]
    events = (purchases.select("user_id", ms().alias("t"), F.coalesce(F.expr(AMOUNT), F.lit(0)).alias("amount"),
                               *[F.col(c).alias(o) for c, o in zip(order, ties)], *flags(first, more))
              .filter((F.col("first") | F.col("more")) & F.col("t").isNotNull() & F.col("user_id").isNotNull()))
    ordered = Window.partitionBy("user_id", "cell").orderBy("t", *ties, "first", "more")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    one = lambda c: F.col(c).cast("int").cast("bigint")
    too_old = Window.partitionBy("user_id", "cell").orderBy("t").rangeBetween(Window.unboundedPreceding, -within)
    ranked = spread_over_cells(events, within).select(
        "user_id", "cell", "t", *ties, "amount", "first", "more",
        F.sum(one("first")).over(so_far).alias("firsts"), F.sum(one("more")).over(so_far).alias("mores"),
        F.sum(F.when(F.col("more"), F.col("amount")).otherwise(0)).over(so_far).alias("paid"),
        F.coalesce(F.sum(one("first")).over(too_old), F.lit(0)).alias("gone"))
    starts = ranked.filter("first").select(
        "user_id", "cell", F.expr(f"(firsts - 1) div {RANKS}").alias("part"), "firsts", F.col("t").alias("first_ts"),
        F.col("mores").alias("mores_a"), (F.col("paid") - F.col("amount")).alias("paid_before"))
    # first events before the ``min_more``-th of the later events that end here
    reach = F.lag(F.col("firsts") - one("first"), min_more - 1).over(ordered)
    ends = ranked.filter("more").withColumn("reach", reach).filter(
        (F.col("reach") > F.col("gone")) & (floor_to(F.col("t"), cell_width(within)) == F.col("cell"))).select(
        "user_id", "cell", F.col("t").alias("last_ts"), "mores", "paid", "gone", "reach",
        F.explode(F.expr(f"sequence(gone div {RANKS}, (reach - 1) div {RANKS})")).alias("part"))
    runs = starts.join(ends, ["user_id", "cell", "part"]).filter("firsts > gone AND firsts <= reach")
    return runs.select(
        "user_id", (F.col("mores") - F.col("mores_a") + 1).cast("int").alias("purchase_count"),
        (F.col("paid") - F.col("paid_before")).cast("double").alias("total_amount_usd"),
        "first_ts", "last_ts", (F.col("last_ts") - F.col("first_ts")).alias("span_ms"))
