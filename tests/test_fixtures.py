"""Boundary cases on stored tables (bounds, ties, merges)."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import events, rows
from wakeline.functions.running import running
from wakeline.operators import joins, lateness, patterns, results, topk, windows

VIEWS = ([("u%d" % i, "A", i) for i in range(10)] + [("u%d" % i, "B", i) for i in range(6)]
         + [("u%d" % i, "C", i) for i in range(3)] + [("u0", "D", 0), ("u-flush", "Z", 120_000)])


def test_topk_first_board(spark):
    board = topk.topk_products(events(spark, VIEWS), 3, 60_000)
    first = board.filter("window_start_ms = 0")
    assert rows(first, "rank", "product_id", "count", "window_end_ms") == [
        (1, "A", 10, 60_000), (2, "B", 6, 60_000), (3, "C", 3, 60_000)]
    assert rows(topk.nest_board(first), "top") == [([("A", 10), ("B", 6), ("C", 3)],)]


def test_topk_tie_goes_to_smaller_product(spark):
    board = topk.topk_products(events(spark, [("u", "B", 1), ("u", "A", 2)]), 1, 1000)
    assert rows(board, "product_id") == [("A",)]


def test_topk_variants_agree(spark):
    rng = random.Random(1)
    views = events(spark, [("u", f"p{int(rng.paretovariate(1)) % 40}", rng.randrange(200_000)) for _ in range(3000)])
    columns = ("window_start_ms", "window_end_ms", "rank", "product_id", "count")
    plain = rows(topk.topk_products(views, 5, 20_000), *columns)
    assert rows(topk.topk_two_level(views, 5, 20_000, buckets=7), *columns) == plain
    assert rows(topk.topk_sql(views, 5, 20_000), *columns) == plain
    salted = windows.salted_counts(views, 20_000, salt_on="ts")
    assert rows(topk.rank_counts(salted, 5), *columns) == plain
    approx = topk.topk_approx(views, 5, 20_000)
    assert rows(approx, *columns) == plain
    assert {r["unlisted_max"] for r in approx.collect()} == {0}


def test_approximate_board_counts_its_candidates_exactly(spark):
    views = events(spark, [("u", f"hot{i % 3}", i) for i in range(3000)] + [("u", f"p{i}", i) for i in range(2000)])
    board = topk.topk_approx(views, 3, 10_000, tracked=64).collect()
    assert [(r["product_id"], r["count"]) for r in sorted(board, key=lambda r: r["rank"])] == [(f"hot{i}", 1000) for i in range(3)]
    assert all(1 <= r["unlisted_max"] <= 2000 for r in board)


def test_key_skew_of_the_latest_window(spark):
    got = topk.key_skew_latest(events(spark, [("u", "A", 1), ("u", "A", 11), ("u", "B", 12), ("u", "A", 13)]), size=10)
    assert rows(got, "product_id", "count", "heat") == [("A", 2, 1.0), ("B", 1, 0.5)]


def test_session_gap(spark):
    got = windows.session_counts(events(spark, [("u", "p", 0), ("u", "p", 30_000), ("u", "p", 60_001)]))
    assert rows(got, "window_start_ms", "window_end_ms", "count") == [(0, 60_000, 2), (60_001, 90_001, 1)]


def test_sessions_equal_session_window(spark):
    rng = random.Random(2)
    data = events(spark, [(f"u{rng.randrange(5)}", f"p{rng.randrange(9)}", rng.randrange(-400_000, 900_000))
                          for _ in range(600)])
    gap = 4_000
    builtin = (data.groupBy("user_id", F.session_window("ts", f"{gap} milliseconds").alias("w"))
               .agg(F.count("*").alias("count"), F.count_distinct("product_id").alias("products"))
               .select(F.unix_millis("w.start").alias("window_start_ms"), F.unix_millis("w.end").alias("window_end_ms"),
                       "user_id", "count", "products"))
    columns = ("window_start_ms", "window_end_ms", "user_id", "count")
    assert rows(windows.session_counts(data, gap), *columns) == rows(builtin, *columns)
    assert rows(windows.session_metrics(data, gap), *columns, "products") == rows(builtin, *columns, "products")


def test_sliding_membership(spark):
    got = windows.sliding_counts(events(spark, [("u", "p", 65_000)]))
    assert rows(got, "window_start_ms", "count") == [(40_000, 1), (50_000, 1), (60_000, 1)]


@pytest.mark.parametrize("size,slide", [(30_000, 10_000), (30_000, 20_000), (10_000, 10_000), (7_000, 3_000), (5_000, 9_000)])
def test_sliding_equals_window_function(spark, size, slide):
    rng = random.Random(size)
    data = events(spark, [("u", "p", rng.randrange(-50_000, 150_000)) for _ in range(300)])
    want = {}
    for (t,) in data.select("ts_ms").collect():
        start = t // slide * slide
        while start > t - size:
            want[start] = want.get(start, 0) + 1
            start -= slide
    got = windows.sliding_counts(data, size, slide)
    assert rows(got, "window_start_ms", "count") == sorted(want.items(), key=repr)
    if size % slide == 0:
        assert got.agg(F.sum("count")).first()[0] == 300 * size // slide


def test_sliding_with_full_slide_is_tumbling(spark):
    data = events(spark, [("u", "p", t * 777) for t in range(200)])
    columns = ("window_start_ms", "window_end_ms", "count")
    assert rows(windows.sliding_counts(data, 5_000, 5_000), *columns) == rows(windows.tumbling_counts(data, 5_000), *columns)


def test_interval_bounds_inclusive(spark):
    views = events(spark, [("a", "v", 100_000), ("c", "v", 100_000)])
    bought = events(spark, [("a", "p", t, 1) for t in (69_999, 70_000, 400_000, 400_001)] + [("b", "p", 100_000, 1)])
    for salts in (1, 5):
        got = joins.interval_join(views, bought, salts=salts)
        assert rows(got, "user_id", "purchase_ts", "delta_ms") == [("a", 400_000, 300_000), ("a", 70_000, -30_000)]


def test_interval_join_equals_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    v = [(f"u{rng.randrange(4)}", f"p{rng.randrange(5)}", rng.randrange(-60_000, 60_000)) for _ in range(200)]
    p = [(f"u{rng.randrange(4)}", f"p{rng.randrange(5)}", rng.randrange(-60_000, 60_000), i) for i in range(200)]
    before, after = 700, 2_500
    want = sorted(((a[0], a[2], b[2], float(b[3])) for a, b in itertools.product(v, p)
                   if a[0] == b[0] and -before <= b[2] - a[2] <= after), key=repr)
    views, bought = events(spark, v), events(spark, p)
    for salts in (1, 3):
        got = joins.interval_join(views, bought, before, after, salts)
        assert rows(got, "user_id", "view_ts", "purchase_ts", "amount_usd") == want
    converted = {(i, a) for i, a in enumerate(v) for b in p if a[0] == b[0] and 0 <= b[2] - a[2] <= after}
    assert rows(joins.funnel(views, bought, after), "views", "converted") == [(200, len(converted))]
    matches = joins.interval_join(views, bought, before, after)
    assert rows(joins.conversion(views, bought, before, after), "*") == rows(joins.same_product_conversion(matches), "*")
    assert rows(joins.conversion(views, bought, before, after), "matches") == [(len(want),)]
    # stretches shorter than the interval, so that totals are carried
    monkeypatch.setattr(joins, "STRETCH", 400)
    assert rows(joins.funnel(views, bought, after), "views", "converted") == [(200, len(converted))]
    assert rows(joins.conversion(views, bought, before, after), "*") == rows(joins.same_product_conversion(matches), "*")
    for latest in (1, 7, 10_000):
        assert rows(joins.latest_conversion(views, bought, before, after, latest), "*") == rows(
            joins.same_product_conversion(matches, latest), "*")
    assert rows(joins.latest_conversion(views, bought.filter("false")), "matches") == [(0,)]
    same = {w: sum(1 for a, b in itertools.product(v, p) if a[0] == b[0] and a[2] // w == b[2] // w) for w in (900,)}
    for salts in (1, 4):
        assert joins.window_join(views, bought, 900, salts).count() == same[900]


def test_conversion(spark):
    views = events(spark, [("a", "x", 0), ("a", "y", 1)])
    bought = events(spark, [("a", "x", 10, 5), ("a", "z", 20, 5)])
    matches = joins.interval_join(views, bought)
    assert rows(joins.same_product_conversion(matches), "matches", "same_product", "conversion_pct") == [(4, 1, 25.0)]
    assert rows(joins.same_product_conversion(matches, latest=2), "matches", "same_product") == [(2, 0)]
    assert rows(joins.conversion(views, bought), "*") == rows(joins.same_product_conversion(matches), "*")
    assert rows(joins.conversion(views.filter("false"), bought), "matches", "conversion_pct") == [(0, None)]
    empty = matches.filter("false")
    assert rows(joins.same_product_conversion(empty), "matches", "conversion_pct") == [(0, None)]


def test_funnel_purchase_at_the_same_moment_and_at_the_bound(spark):
    views = events(spark, [("a", "x", 1_000), ("a", "x", 1_000), ("b", "x", 0), ("c", "x", 0), ("d", "x", 9)])
    bought = events(spark, [("a", "x", 1_000, 1), ("b", "x", 300_000, 1), ("c", "x", 300_001, 1), ("d", "x", 8, 1)])
    assert rows(joins.funnel(views, bought), "views", "converted") == [(5, 3)]


ALERT = ("user_id", "purchase_count", "total_amount_usd", "first_ts", "last_ts")


@pytest.mark.parametrize("times,want", [
    ([0, 1000, 9999], [("u", 3, 6.0, 0, 9999)]),
    ([0, 1000, 10_000], []),
    ([0, 1000, 2000, 3000], [("u", 3, 6.0, 0, 2000), ("u", 3, 9.0, 1000, 3000), ("u", 4, 10.0, 0, 3000)]),
])
def test_rapid_purchases(spark, times, want):
    bought = events(spark, [("u", "p", t, i + 1) for i, t in enumerate(times)])
    assert rows(patterns.rapid_purchases(bought), *ALERT) == want


def test_rapid_purchases_long_burst(spark):
    bought = events(spark, [("u", "p", 33 * i, 1.25) for i in range(90)])
    assert patterns.rapid_purchases(bought).count() == 89 * 88 // 2


def brute_force_runs(data, min_times, within):
    want = []
    for user in {r[0] for r in data}:
        mine = sorted((t, p, a) for u, p, t, a in data if u == user)
        for j in range(len(mine)):
            for i in range(j - min_times + 1, -1, -1):
                if mine[j][0] - mine[i][0] < within:
                    total = round(sum(a for _, _, a in mine[i:j + 1]), 2)
                    want.append((user, j - i + 1, total, mine[i][0], mine[j][0]))
    return sorted(want, key=repr)


@pytest.mark.parametrize("seed,min_times,within", [(1, 3, 900), (2, 2, 333), (3, 5, 2_000)])
def test_rapid_purchases_equal_brute_force(spark, monkeypatch, seed, min_times, within):
    # small groups, so that runs cross the borders of rank groups and time cells
    monkeypatch.setattr(patterns, "RANKS", 4)
    rng = random.Random(seed)
    data = [(f"u{rng.randrange(3)}", f"p{rng.randrange(4)}", rng.randrange(-9_000, 9_000), rng.randrange(1000) / 100)
            for _ in range(250)]
    got = patterns.rapid_purchases(events(spark, data), min_times, within)
    assert rows(got, *ALERT) == brute_force_runs(data, min_times, within)


def test_rapid_purchases_skip_what_does_not_match(spark):
    bought = events(spark, [("u", "p", 0, 50), ("u", "p", 1, 5), ("u", "p", 2, 50), ("u", "p", 3, 50)])
    got = patterns.rapid_purchases(bought, where=F.col("amount_usd") > 20)
    assert rows(got, *ALERT) == [("u", 3, 150.0, 0, 3)]


def test_rank_movement(spark):
    board = spark.createDataFrame(
        [(0, 1, "A"), (0, 2, "B"), (0, 3, "C"), (50_000, 1, "B"), (50_000, 2, "A"), (50_000, 3, "D")],
        "window_start_ms bigint, rank int, product_id string")
    for chunk in (10_000, 1_000_000):
        got = topk.rank_movement(board, chunk).filter("window_start_ms > 0")
        assert rows(got, "product_id", "movement") == [("A", -1), ("B", 1), ("D", None)]


def test_concurrency(spark):
    intervals = spark.createDataFrame([(0, 10), (10, 20), (5, 15)], "window_start_ms bigint, window_end_ms bigint")
    assert rows(results.max_concurrent(intervals), "max_concurrent") == [(2,)]
    for chunk in (3, 7, 1000):
        got = results.concurrency(intervals, chunk=chunk)
        assert rows(got, "at_ms", "open") == sorted([(0, 1), (5, 2), (10, 2), (15, 1), (20, 0)], key=repr)


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("how", ["max", "sum"])
def test_running_over_chunks(spark, inclusive, how):
    rng = random.Random(4)
    data = [(i * 3 - 100, rng.choice([None, rng.randrange(-50, 50)])) for i in range(120)]
    want = []
    for i, (pos, _) in enumerate(data):
        seen = [x for _, x in data[:i + inclusive] if x is not None]
        want.append((pos, (max if how == "max" else sum)(seen) if seen else None))
    df = spark.createDataFrame(data, "pos bigint, x bigint")
    for chunk in (7, 10_000):
        assert rows(running(df, "pos", {"x": how}, chunk, inclusive), "pos", "x") == sorted(want, key=repr)


def test_lag_bands(spark):
    df = spark.createDataFrame([(4999,), (5000,), (29_999,), (30_000,)], "lag bigint")
    got = [r[0] for r in df.select(lateness.lag_band(F.col("lag"))).collect()]
    assert got == ["ok", "slow", "slow", "stuck"]


def log(spark, data):
    """Rows of (batch, partition, ts_ms)."""
    df = spark.createDataFrame([(b, p, t, 0) for b, p, t in data], "batch bigint, partition int, ts_ms bigint, arrival_ms bigint")
    return df.withColumn("ts", F.timestamp_millis("ts_ms"))


def test_min_watermark_carries_absent_partitions(spark):
    arrivals = log(spark, [(0, 0, 10_000), (1, 1, 7_000), (2, 0, 20_000), (3, 1, 30_000)])
    got = lateness.min_watermark(arrivals, [0, 1])
    assert rows(got, "batch", "min_watermark_ms", "max_watermark_ms") == [
        (0, None, 5_000), (1, 2_000, 5_000), (2, 2_000, 15_000), (3, 15_000, 25_000)]


def test_lateness_family(spark):
    # delay 5 s, windows of 10 s: the watermark is 10000 once batch 0 is in
    arrivals = log(spark, [(0, 0, 15_000), (1, 0, 9_000), (1, 0, 10_000), (1, 0, 40_000), (2, 0, 5_000), (2, 0, 39_000)])
    replay = lateness.replay_watermarks(arrivals)
    assert rows(replay, "batch", "ts_ms", "watermark_ms", "is_late") == sorted([
        (0, 15_000, None, False), (1, 9_000, 10_000, True), (1, 10_000, 10_000, False), (1, 40_000, 10_000, False),
        (2, 5_000, 35_000, True), (2, 39_000, 35_000, False)], key=repr)
    assert rows(lateness.late_counts(arrivals), "is_late", "count") == [(False, 4), (True, 2)]
    assert rows(lateness.late_side_output(arrivals), "batch", "ts_ms") == [(1, 9_000), (2, 5_000)]
    assert rows(lateness.late_dropped_windows(arrivals), "window_start_ms", "dropped") == [(0, 2)]
    allowed = lateness.allowed_lateness(arrivals, lateness=10_000)
    assert rows(allowed.filter("window_start_ms = 0"), "count", "on_time", "refired") == [(1, 0, 1)]


def test_dedup_and_recent(spark):
    df = spark.createDataFrame([("tumbling", 0, 10, 1, None), ("tumbling", 0, 10, 1, None), ("session", 0, 9, 1, "a"),
                                ("session", 0, 9, 1, "b")],
                               "kind string, window_start_ms bigint, window_end_ms bigint, count bigint, user_id string")
    assert results.dedup_windows(df).count() == 3
    assert rows(results.recent_span(df), "kind", "start_ms", "end_ms") == [("session", 0, 9), ("tumbling", 0, 10)]
    newest = [F.desc("window_end_ms"), F.asc("user_id")]
    assert rows(results.latest_per_type(df, newest, by="kind"), "kind", "user_id") == [("session", "a"), ("tumbling", None)]


def test_dedup_first_wins(spark):
    df = spark.createDataFrame([("tumbling", 0, 10, 5, None, 2), ("tumbling", 0, 10, 4, None, 1), ("session", 0, 9, 1, "a", 3)],
                               "kind string, window_start_ms bigint, window_end_ms bigint, count bigint, user_id string, seq int")
    assert rows(results.dedup_windows(df, "seq"), "kind", "count", "seq") == [("session", 1, 3), ("tumbling", 4, 1)]


def test_new_accounts_and_threshold(spark):
    bought = events(spark, [("new", "p", t, 60) for t in (1, 2, 3)] + [("old", "p", t, 60) for t in (9001, 9002, 9003)])
    activity = events(spark, [("new", "p", 0), ("old", "p", 0)])
    alerts = patterns.rapid_purchases(bought)
    assert rows(patterns.new_account_bursts(alerts, activity, 5_000), "user_id", "account_age_ms") == [("new", 1)]
    assert rows(patterns.threshold_anomaly(bought, 179.99, 10_000), "user_id", "spent_usd") == [("new", 180.0), ("old", 180.0)]
    assert patterns.threshold_anomaly(bought, 180, 10_000).count() == 0


def test_small_amounts_add_up(spark):
    """Sums are not cut to cents, row by row or at the end."""
    bought = spark.range(1000).selectExpr("'u' AS user_id", "'p' AS product_id", "0.004D AS amount_usd", "5L AS ts_ms",
                                          "timestamp_millis(5) AS ts")
    assert rows(windows.gmv(bought, 1000), "gmv_usd", "purchases") == [(4.0, 1000)]
    assert rows(patterns.threshold_anomaly(bought, 3.9, 1000), "spent_usd") == [(4.0,)]
    alerts = patterns.rapid_purchases(bought.limit(3), 3, 10)
    assert rows(alerts, "purchase_count", "total_amount_usd") == [(3, 0.012)]


def test_null_users_match_nobody(spark):
    """As in the interval join, also with null products and times."""
    events = [(None, "a", 1000), (None, None, 1100), ("u", "a", 1000), ("u", None, 1200), ("u", "b", None)]
    make = lambda more: spark.createDataFrame(events, "user_id string, product_id string, ts_ms long").withColumn(
        "ts", F.timestamp_millis("ts_ms")).selectExpr("*", *more)
    views, bought = make([]), make(["1.0D AS amount_usd"])
    pairs = joins.interval_join(views, bought, 500, 500)
    assert rows(joins.conversion(views, bought, 500, 500), "matches", "same_product") == rows(
        joins.same_product_conversion(pairs), "matches", "same_product") == [(4, 1)]
    timed = views.filter("ts is not null")
    assert rows(joins.funnel(timed, bought, 500), "views", "converted") == [(4, 2)]
