"""View-to-purchase joins: by time interval, by shared window, and the conversion funnel."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wakeline.functions.timecols import MINUTE, SECOND, bounds, floor_to, ms
from wakeline.operators.windows import stream_window

MATCH_COLUMNS = ("user_id", "product_id_viewed", "product_id_purchased", "view_ts", "purchase_ts", "amount_usd")


def _views(views: DataFrame) -> DataFrame:
    return views.select("user_id", F.col("product_id").alias("product_id_viewed"),
                        *(["ts"] if views.isStreaming else []), ms().alias("view_ts"))


def _purchases(purchases: DataFrame) -> DataFrame:
    return purchases.select("user_id", F.col("product_id").alias("product_id_purchased"), "amount_usd",
                            *(["ts"] if purchases.isStreaming else []), ms().alias("purchase_ts"))


def _salted(left: DataFrame, right: DataFrame, salt_on: tuple[str, ...], salts: int):
    """Spread every key of ``left`` over ``salts`` keys and copy ``right`` to each of them."""
    if salts == 1:
        return left, right, []
    salt = F.pmod(F.xxhash64(*salt_on), F.lit(salts).cast("bigint"))
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    return left.withColumn("salt", salt), right.withColumn("salt", copies), ["salt"]


def interval_join(views: DataFrame, purchases: DataFrame, before: int = 30 * SECOND,
                  after: int = 5 * MINUTE, salts: int = 1) -> DataFrame:
    """Every (view, purchase) of one user with ``-before <= purchase - view <= after``, inclusive.

    The join key is (user, time cell), so a user with a large part of all rows is spread over
    cells and only neighbouring cells are compared.  On a stored table a cell that is itself too
    large is split at run time by the adaptive skew join.  ``salts`` > 1 splits every key (views
    by hash, purchases copied) up front, for streams and for sessions without adaptive
    execution.  The result is the same for any value.

    Streams: watermark both inputs; Spark derives from the bounds how long each side is kept.
    """
    v, p, extra = _salted(_views(views), _purchases(purchases), ("view_ts", "product_id_viewed"), salts)
    # a cell twice as wide as the interval: a purchase is copied to 1.5 cells on average
    width = 2 * (before + after + 1)
    v = v.withColumn("cell", floor_to(F.col("view_ts"), width))
    p = p.withColumn("cell", F.explode(F.sequence(
        floor_to(F.col("purchase_ts") - after, width), floor_to(F.col("purchase_ts") + before, width),
        F.lit(width).cast("bigint"))))
    if views.isStreaming:
        # the bounds on the event-time columns let Spark drop state that can no longer match
        keys = " AND ".join(f"v.{key} = p.{key}" for key in ["user_id", "cell", *extra])
        joined = v.alias("v").join(p.alias("p"), F.expr(
            f"{keys} AND p.ts >= v.ts - INTERVAL '{before / 1000:.3f}' SECOND "
            f"AND p.ts <= v.ts + INTERVAL '{after / 1000:.3f}' SECOND"))
        pairs = joined.select("v.user_id", "v.product_id_viewed", "p.product_id_purchased", "v.view_ts",
                              "p.purchase_ts", "p.amount_usd")
    else:
        delta = F.col("purchase_ts") - F.col("view_ts")
        pairs = v.join(p, ["user_id", "cell", *extra]).filter((delta >= -before) & (delta <= after))
    return pairs.select(*MATCH_COLUMNS[:-1], (F.col("purchase_ts") - F.col("view_ts")).alias("delta_ms"), "amount_usd")


def window_join(views: DataFrame, purchases: DataFrame, size: int = 10 * SECOND, salts: int = 1) -> DataFrame:
    """Every (view, purchase) of one user that fall into the same tumbling window."""
    v, p, extra = _salted(_views(views), _purchases(purchases), ("view_ts", "product_id_viewed"), salts)
    if views.isStreaming:
        v = v.select("user_id", "product_id_viewed", "view_ts", stream_window(size).alias("w"), *extra)
        p = p.select("user_id", "product_id_purchased", "purchase_ts", "amount_usd", stream_window(size).alias("w"), *extra)
        return v.join(p, ["user_id", "w", *extra]).select(*bounds("w"), *MATCH_COLUMNS)
    v = v.withColumn("window_start_ms", floor_to(F.col("view_ts"), size))
    p = p.withColumn("window_start_ms", floor_to(F.col("purchase_ts"), size))
    return v.join(p, ["user_id", "window_start_ms", *extra]).select(
        "window_start_ms", (F.col("window_start_ms") + size).alias("window_end_ms"), *MATCH_COLUMNS)


def _with_rate(totals: DataFrame) -> DataFrame:
    return totals.withColumn("conversion_pct", F.when(
        F.col("matches") > 0, F.col("same_product").cast("double") / F.col("matches") * 100))


def same_product_conversion(matches: DataFrame, latest: int | None = None) -> DataFrame:
    """Share of given matches in which the viewed product was bought, over all or the ``latest`` n."""
    if latest is not None:
        matches = matches.orderBy(F.desc("purchase_ts"), F.desc("view_ts"), "user_id", "product_id_viewed",
                                  "product_id_purchased").limit(latest)
    same = F.col("product_id_viewed") == F.col("product_id_purchased")
    return _with_rate(matches.agg(F.count(F.lit(1)).alias("matches"), F.count_if(same).alias("same_product")))


#: Width of the stretches in which events are counted; what came before one is carried in as a total.
STRETCH = 10 * MINUTE


def _weighted_counts(rows: DataFrame, *keys: str) -> DataFrame:
    """Per (keys, stretch) the sums of ``n`` and of ``total``: the ``weight`` of each row times the sum
    of ``n`` over all rows of its keys with ``at`` not after its own.

    Rows are ordered inside a stretch only; the pass over a whole key sees one row per stretch.
    """
    rows = rows.withColumn("stretch", floor_to(F.col("at"), STRETCH))
    # the default frame takes in all rows of the same time
    so_far = F.sum("n").over(Window.partitionBy(*keys, "stretch").orderBy("at"))
    stretches = (rows.select(*keys, "stretch", "weight", "n", (F.col("weight") * so_far).alias("inside"))
                 .groupBy(*keys, "stretch").agg(*[F.sum(c).alias(c) for c in ("weight", "n", "inside")]))
    earlier = Window.partitionBy(*keys).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    return stretches.select(*keys, "n", (F.col("inside") + F.col("weight") * carried).alias("total"))


def conversion(views: DataFrame, purchases: DataFrame, before: int = 30 * SECOND,
               after: int = 5 * MINUTE) -> DataFrame:
    """``same_product_conversion`` of the whole interval join, without forming its pairs.

    Events are folded to one row per user, scope (any product, or one) and millisecond.  The running
    number of purchases is read at both ends of the interval of every view; the difference is the
    number of its matches.  No group grows with the interval.
    """
    scopes = F.explode(F.array(F.struct(F.lit(False).alias("same"), F.lit(None).cast("string").alias("product")),
                               F.struct(F.lit(True).alias("same"), F.col("product_id").alias("product"))))
    scope = ("user_id", "same", "product")

    def fold(events: DataFrame) -> DataFrame:
        rows = events.select("user_id", ms().alias("t"), scopes.alias("s")).select("user_id", "s.*", "t")
        # as in a join, a null user, product or time is equal to none
        return (rows.filter("user_id is not null and t is not null and (not same or product is not null)")
                .groupBy(*scope, "t").agg(F.count(F.lit(1)).alias("n")))

    none = F.lit(0).cast("bigint")
    ends = F.explode(F.array(F.struct((F.col("t") + after).alias("at"), F.col("n").alias("weight")),
                             F.struct((F.col("t") - (before + 1)).alias("at"), (-F.col("n")).alias("weight"))))
    probes = fold(views).select(*scope, ends.alias("e")).select(*scope, "e.at", "e.weight", none.alias("n"))
    bought = fold(purchases).select(*scope, F.col("t").alias("at"), none.alias("weight"), "n")
    matched = _weighted_counts(probes.unionByName(bought), *scope)
    return _with_rate(matched.agg(
        F.coalesce(F.sum(F.when(~F.col("same"), F.col("total"))), none).alias("matches"),
        F.coalesce(F.sum(F.when(F.col("same"), F.col("total"))), none).alias("same_product")))


def latest_conversion(views: DataFrame, purchases: DataFrame, before: int = 30 * SECOND, after: int = 5 * MINUTE,
                      latest: int = 12) -> DataFrame:
    """``same_product_conversion`` of the ``latest`` matches of the interval join.

    The last view that can belong to each purchase is looked up without pairs.  Only purchases from
    the ``latest``-th newest matched time on can be in the result, so only those are joined.
    """
    seen = views.select("user_id", ms().alias("at"), ms().alias("seen"), F.lit(None).cast("bigint").alias("t"))
    asked = purchases.select("user_id", (ms() + before).alias("at"), F.lit(None).cast("bigint").alias("seen"), ms().alias("t"))
    rows = (seen.unionByName(asked).filter("user_id is not null and at is not null").distinct()
            .withColumn("stretch", floor_to(F.col("at"), STRETCH)))
    inside = rows.withColumn("near", F.max("seen").over(Window.partitionBy("user_id", "stretch").orderBy("at")))
    earlier = Window.partitionBy("user_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy("user_id", "stretch").agg(F.max("seen").alias("seen")).select(
        "user_id", "stretch", F.max("seen").over(earlier).alias("carried"))
    matched = (inside.filter("t is not null").join(carried, ["user_id", "stretch"])
               .filter(F.coalesce("near", "carried") >= F.col("t") - after))
    newest = matched.select("t").distinct().orderBy(F.desc("t")).limit(latest)
    since = newest.agg(F.min("t")).scalar()
    return same_product_conversion(
        interval_join(views.filter(ms() >= since - after), purchases.filter(ms() >= since), before, after), latest)


def funnel(views: DataFrame, purchases: DataFrame, within: int = 5 * MINUTE) -> DataFrame:
    """Views, views followed by a purchase of the same user within ``within`` ms, and the rate.

    No pairs are formed: a purchase converts the views of the ``within`` ms up to it, save those that
    the purchase before it has converted, and the running number of views is read at both ends of
    that stretch of time.  No group grows with ``within``.
    """
    v = views.select("user_id", ms().alias("at")).groupBy("user_id", "at").agg(F.count(F.lit(1)).alias("n"))
    # as in a join, a null user is equal to none: such views are counted and never converted
    p = (purchases.select("user_id", ms().alias("t")).filter("user_id is not null and t is not null").distinct()
         .withColumn("stretch", floor_to(F.col("t"), STRETCH)))
    following = p.select("user_id", "t", F.lag("t").over(Window.partitionBy("user_id", "stretch").orderBy("t")).alias("prev"))
    # the first purchase of a stretch follows the last one of the stretch before
    leading = p.groupBy("user_id", "stretch").agg(F.min("t").alias("t"), F.max("t").alias("last")).select(
        "user_id", "t", F.lag("last").over(Window.partitionBy("user_id").orderBy("stretch")).alias("prev"))
    ends = F.explode(F.array(
        F.struct(F.col("t").alias("at"), F.lit(1).alias("weight")),
        F.struct(F.greatest("prev", F.col("t") - (within + 1)).alias("at"), F.lit(-1).alias("weight"))))
    probes = (following.filter("prev is not null").unionByName(leading)
              .select("user_id", ends.alias("e")).select("user_id", "e.*", F.lit(0).alias("n")))
    counted = _weighted_counts(v.withColumn("weight", F.lit(0)).unionByName(probes), "user_id")
    totals = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("views"), F.coalesce(F.sum("total"), F.lit(0)).alias("converted"))
    return totals.withColumn("rate", F.when(F.col("views") > 0, F.col("converted").cast("double") / F.col("views")))


def funnel_stream(views: DataFrame, purchases: DataFrame, within: int = 5 * MINUTE) -> DataFrame:
    """The funnel on streams with watermarks: (user_id, view_ts, views, purchase_ts), one row per user and millisecond
    with views, once no purchase can come for them any more; ``purchase_ts`` is the first that follows, or null.

    Both sides are folded per user and millisecond before they are joined, and the matches of a view to their first one
    behind it.  State is held for ``within`` and the delays.
    """
    cell = F.window("ts", "1 millisecond").alias("w")
    v = (views.groupBy(F.col("user_id").alias("v_user"), cell).agg(F.count(F.lit(1)).alias("views"))
         .select("v_user", F.window_time("w").alias("v_ts"), "views"))
    p = purchases.filter(F.col("user_id").isNotNull()).groupBy(F.col("user_id").alias("p_user"), cell).agg(F.count(F.lit(1))).select(
        "p_user", F.window_time("w").alias("p_ts"))
    near = (F.col("v_user") == F.col("p_user")) & (F.col("p_ts") >= F.col("v_ts")) & (
        F.col("p_ts") <= F.col("v_ts") + F.expr(f"INTERVAL {within} MILLISECONDS"))
    matched = v.join(p, near, "left_outer").groupBy(F.window("v_ts", "1 millisecond").alias("vw"), "v_user").agg(
        F.max("views").alias("views"), F.min("p_ts").alias("p_ts"))
    return matched.select(F.col("v_user").alias("user_id"), ms(F.col("vw.start")).alias("view_ts"), "views", ms(F.col("p_ts")).alias("purchase_ts"))


def funnel_totals(rows: DataFrame) -> DataFrame:
    """``funnel`` of the rows of ``funnel_stream``."""
    totals = rows.agg(F.coalesce(F.sum("views"), F.lit(0)).alias("views"),
                      F.coalesce(F.sum(F.when(F.col("purchase_ts").isNotNull(), F.col("views"))), F.lit(0)).alias("converted"))
    return totals.withColumn("rate", F.when(F.col("views") > 0, F.col("converted").cast("double") / F.col("views")))
