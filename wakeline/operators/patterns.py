"""Event-pattern alerts: bursts of purchases, spending thresholds, bursts of new accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wakeline.functions.timecols import DAY, SECOND, duration, floor_to, ms
from wakeline.operators.windows import AMOUNT, window_sums

# ranks per join group when runs are spelled out
RANKS = 256


def cell_width(within: int) -> int:
    return 4 * within


def spread_over_cells(events: DataFrame, within: int, t: str = "t") -> DataFrame:
    """Give each event its time ``cell``, and a copy in the next cell if a run may reach into it.

    All runs that end in a cell can then be found from the rows of (user, cell) alone, which
    splits a busy user over cells at the price of a quarter more rows.
    """
    width = cell_width(within)
    return events.withColumn("cell", F.explode(F.sequence(
        floor_to(F.col(t), width), floor_to(F.col(t) + (within - 1), width), F.lit(width).cast("bigint"))))


def rapid_purchases(purchases: DataFrame, min_times: int = 3, within: int = 10 * SECOND,
                    where: Column | None = None, order: tuple[str, ...] = ("product_id", "amount_usd")) -> DataFrame:
    """One alert per run of at least ``min_times`` events of a user inside ``within`` ms (strict).

    Every contiguous run counts, so n events inside the bound give one alert for each pair of a
    first and a last event that are far enough apart.  With ``where``, events that do not match
    are skipped, not run breakers.  ``order`` ranks events of equal time.

    The work follows the number of alerts: events are ranked inside (user, time cell), which
    spreads a busy user; only events that start or end some run go on; and the pairs are formed in
    groups of ``RANKS`` starts, so a huge burst is spread over tasks too.  Only the ordering of one
    cell (5 * ``within`` of one user) is a single task; a cell too large for that would hold an
    unwritable, quadratic number of alerts.

    On a stream (with a watermark on ``ts``) the alerts of a cell come when it closes; see
    ``streaming.bursts`` for alerts that do not wait for that.
    """
    if purchases.isStreaming:
        return _runs_of_closed_cells(purchases, min_times, within, where, order)
    if where is not None:
        purchases = purchases.filter(where)
    # events equal in every ordering column are interchangeable, so their order does not matter
    ties = [f"o{i}" for i in range(len(order))]
    events = (purchases.select("user_id", ms().alias("t"), F.coalesce(F.expr(AMOUNT), F.lit(0)).alias("amount"),
                               *[F.col(c).alias(o) for c, o in zip(order, ties)])
              .filter(F.col("t").isNotNull() & F.col("user_id").isNotNull()))
    ordered = Window.partitionBy("user_id", "cell").orderBy("t", *ties)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    far = min_times - 1
    pause = F.coalesce(F.col("t") - F.lag("t").over(ordered) >= within, F.lit(True))
    ranked = spread_over_cells(events, within).select(
        "user_id", "cell", "t", *ties, "amount", F.row_number().over(ordered).alias("rn"),
        F.sum("amount").over(so_far).alias("running"), pause.alias("pause"),
        (F.lead("t", far).over(ordered) - F.col("t") < within).alias("starts"),
        (F.col("t") - F.lag("t", far).over(ordered) < within).alias("ends"))
    # no run reaches back over a pause of `within` or more
    marked = ranked.withColumn("run_from", F.max(F.when(F.col("pause"), F.col("rn"))).over(so_far))
    starts = ranked.filter("starts").select(
        "user_id", "cell", F.expr(f"rn div {RANKS}").alias("part"), F.col("rn").alias("rn_a"),
        F.col("t").alias("first_ts"), (F.col("running") - F.col("amount")).alias("paid_before"))
    ends = marked.filter(F.col("ends") & (floor_to(F.col("t"), cell_width(within)) == F.col("cell"))).select(
        "user_id", "cell", F.col("rn").alias("rn_b"), F.col("t").alias("last_ts"), "running",
        F.explode(F.expr(f"sequence(run_from div {RANKS}, (rn - {far}) div {RANKS})")).alias("part"))
    runs = (starts.join(ends, ["user_id", "cell", "part"])
            .filter((F.col("rn_b") - F.col("rn_a") >= far) & (F.col("last_ts") - F.col("first_ts") < within)))
    return runs.select(
        "user_id", (F.col("rn_b") - F.col("rn_a") + 1).cast("int").alias("purchase_count"),
        (F.col("running") - F.col("paid_before")).cast("double").alias("total_amount_usd"),
        "first_ts", "last_ts", (F.col("last_ts") - F.col("first_ts")).alias("span_ms"))


def above_watermark(where: Column) -> Column:
    """A filter that Spark does not move below the watermark of ``ts``: events that do not match
    must still advance it.  The equality with ``ts`` is what holds it in place."""
    return F.when(where, F.col("ts")) == F.col("ts")


def units() -> Column:
    """The amount in billionths as a long, for sums kept in state; one alert's sum may reach nine billion."""
    return (F.expr(AMOUNT) * F.lit(10 ** 9).cast("decimal(10,0)")).cast("bigint")


def units_to_usd(units: Column) -> Column:
    return (units.cast("decimal(20,0)") * F.expr("0.000000001BD")).cast("double")


def _runs_of_closed_cells(purchases: DataFrame, min_times: int, within: int, where: Column | None,
                          order: tuple[str, ...]) -> DataFrame:
    """The streaming form: events are gathered per (user, cell and the stretch before it); once the
    watermark closes it, the group is cut into parts of ``RANKS`` events, and each pair of parts that
    can hold both ends of a run is spelled out by itself."""
    if where is not None:
        purchases = purchases.filter(above_watermark(where))
    width = 2 * within
    reach = F.window("ts", duration(width + within), duration(width), duration(width - within))
    event = F.struct(ms().alias("t"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                     units().alias("units"))
    closed = (purchases.filter(F.col("user_id").isNotNull()).groupBy("user_id", reach.alias("w"))
              .agg(F.collect_list(event).alias("events"), F.count(F.lit(1)).cast("int").alias("n"))
              .filter(F.col("n") >= min_times))
    cut = closed.select("user_id", (ms(F.col("w.end")) - width).alias("cell"), F.sort_array("events").alias("e")).withColumn(
        "parts", F.expr(f"transform(sequence(0, (size(e) - 1) div {RANKS}), k -> slice(e, k * {RANKS} + 1, {RANKS}))"))
    paid_in = F.transform("parts", lambda p: F.aggregate(p, F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x["units"], F.lit(0))))
    # each part with the sum of what was paid before it; both ends of a run come from such parts
    parts = F.posexplode(F.arrays_zip("parts", "paid_in")).alias("kb", "b")
    ends = cut.withColumn("paid_in", paid_in).select("user_id", "cell", "parts", "paid_in", parts).select(
        "user_id", "cell", "paid_in", "kb", F.col("b.parts").alias("eb"), F.explode(F.expr(f"""
            filter(transform(slice(parts, 1, kb + 1), (p, k) -> struct(k AS ka, p AS ea)),
                   a -> (kb - a.ka) * {RANKS} + size(b.parts) - 1 >= {min_times - 1}
                        AND b.parts[0].t - element_at(a.ea, -1).t < {within}
                        AND element_at(b.parts, -1).t >= cell)""")).alias("a"))
    running = "aggregate({e}, array({base}), (acc, x) -> array_append(acc, element_at(acc, -1) + coalesce(x.units, 0L)))"
    total = "aggregate(slice(paid_in, 1, {k}), 0L, (s, x) -> s + x)"
    # one row per pair of parts, of a bounded size, so that a large burst goes to many tasks
    pairs = ends.select("user_id", "cell", "kb", "eb", "a.ka", "a.ea", F.expr(total.format(k="a.ka")).alias("base_a"),
                        F.expr(total.format(k="kb")).alias("base_b")).repartition("user_id", "cell", "ka", "kb")
    marked = pairs.select("user_id", "cell", "ka", "kb", "ea", "eb", F.expr(running.format(e="ea", base="base_a")).alias("paid_a"),
                          F.posexplode(F.expr(running.format(e="eb", base="base_b"))).alias("j", "paid"))
    last = marked.filter("j > 0").select("user_id", "cell", "ka", "ea", "paid_a", "paid", F.expr("eb[j - 1].t").alias("last_ts"),
                                         F.expr(f"(kb - ka) * {RANKS} + j - 1").alias("ahead")).filter("last_ts >= cell")
    # ``ahead``: places from the first event of the part to the last one of the run
    return last.select("user_id", "last_ts", F.inline(F.expr(f"""
        transform(filter(sequence(0, size(ea) - 1), i -> ahead - i >= {min_times - 1} AND last_ts - ea[i].t < {within}),
                  i -> struct(ahead - i + 1 AS purchase_count, paid - paid_a[i] AS units, ea[i].t AS first_ts))"""))).select(
        "user_id", "purchase_count", units_to_usd(F.col("units")).alias("total_amount_usd"), "first_ts", "last_ts",
        (F.col("last_ts") - F.col("first_ts")).alias("span_ms"))


def threshold_anomaly(purchases: DataFrame, threshold: float, size: int = DAY) -> DataFrame:
    """Users whose purchases in one window add up to more than ``threshold``."""
    sums = window_sums(purchases, {"spent": AMOUNT, "purchases": "1L"}, ("user_id",), size)
    return sums.filter(F.col("spent") > F.lit(threshold).cast("decimal(28,9)")).select(
        "window_start_ms", "window_end_ms", "user_id", "purchases", F.col("spent").cast("double").alias("spent_usd"))


def new_account_bursts(alerts: DataFrame, activity: DataFrame, max_age: int = 7 * DAY) -> DataFrame:
    """Alerts that begin at most ``max_age`` ms after the first event of their user."""
    first = activity.groupBy("user_id").agg(F.min(ms()).alias("first_seen_ms"))
    age = F.col("first_ts") - F.col("first_seen_ms")
    return alerts.join(first, "user_id").filter(age <= max_age).select(*alerts.columns, age.alias("account_age_ms"))
