"""Streaming runs over small JSON files, one file per micro-batch."""

import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import as_json, events, rows, run, stream, write_batch, write_batches
from tests.test_fixtures import VIEWS, brute_force_runs
from wakeline import schemas
from wakeline.operators import joins, patterns, results, topk, windows
from wakeline.streaming.batches import keep_recent, split_late
from wakeline.streaming import late_sessions, stages
from wakeline.streaming.bursts import rapid_purchases_stream
from wakeline.streaming.run import AVAILABLE_NOW, finish, start

COUNTS = ("window_start_ms", "window_end_ms", "count")
ALERT = ("user_id", "purchase_count", "total_amount_usd", "first_ts", "last_ts")
FLUSH = [("flush", "flush", 10_000_000)]


def shuffled(seed, n, spread, span=120_000, users=4):
    """Events in order, each delayed by less than ``spread`` ms of arrival."""
    rng = random.Random(seed)
    data = [(f"u{rng.randrange(users)}", f"p{int(rng.paretovariate(1.2)) % 12}", rng.randrange(span), rng.randrange(5000) / 100)
            for _ in range(n)]
    return sorted(data, key=lambda e: e[2] + rng.randrange(spread))


def in_files(data, n):
    size = -(-len(data) // n)
    return [data[i:i + size] for i in range(0, len(data), size)]


def test_topk_first_board(spark, tmp_path):
    write_batches(f"{tmp_path}/in", [VIEWS[:-1], VIEWS[-1:]])
    views = stream(spark, f"{tmp_path}/in", schemas.PAGE_VIEW, 0)
    board = run(topk.topk_stream(views, 3, 60_000), tmp_path)
    assert rows(board, "window_start_ms", "window_end_ms", "top") == [(0, 60_000, [("A", 10), ("B", 6), ("C", 3)])]


@pytest.fixture(scope="module")
def disordered(tmp_path_factory):
    data = shuffled(5, 400, 3_000)
    folder = tmp_path_factory.mktemp("in")
    write_batches(str(folder), in_files(data, 4) + [FLUSH])
    return data, str(folder)


@pytest.mark.parametrize("name,build,columns", [
    ("tumbling", lambda v: windows.tumbling_counts(v), COUNTS),
    ("sliding", lambda v: windows.sliding_counts(v), COUNTS),
    ("product", lambda v: windows.counts_by_product(v), (*COUNTS, "product_id")),
    ("salted", lambda v: windows.salted_counts(v, salts=3), (*COUNTS, "product_id")),
    ("session", lambda v: windows.session_counts(v, 4_000), (*COUNTS, "user_id")),
    ("metrics", lambda v: windows.session_metrics(v, 4_000), (*COUNTS, "user_id", "duration_ms", "products")),
    ("topk", lambda v: topk.topk_products(v, 3), (*COUNTS, "rank", "product_id")),
    ("topk_sliding", lambda v: topk.topk_products(v, 3, 30_000, 10_000), (*COUNTS, "rank", "product_id")),
    ("gmv", lambda v: windows.gmv(v), ("window_start_ms", "gmv_usd", "purchases")),
    ("aggregate", lambda v: windows.window_aggregate(v, [F.min("amount_usd").alias("least")], ("user_id",)),
     ("window_start_ms", "window_end_ms", "user_id", "least")),
    ("gmv_sliding", lambda v: windows.gmv(v, 30_000, 10_000), ("window_start_ms", "gmv_usd", "purchases")),
    ("threshold", lambda v: patterns.threshold_anomaly(v, 60, 20_000), ("window_start_ms", "user_id", "purchases", "spent_usd")),
])
def test_stream_equals_batch(spark, tmp_path, disordered, name, build, columns):
    data, folder = disordered
    got = run(build(stream(spark, folder, schemas.PURCHASE, 5_000)), tmp_path)
    assert rows(got, *columns) == rows(build(events(spark, data)), *columns)
    assert got.count() > 0


@pytest.mark.parametrize("build", [
    lambda v, p: joins.interval_join(v, p, 1_500, 4_000),
    lambda v, p: joins.interval_join(v, p, 1_500, 4_000, salts=3),
    lambda v, p: joins.window_join(v, p, 10_000),
    lambda v, p: joins.window_join(v, p, 10_000, salts=3),
])
def test_stream_join_equals_batch(spark, tmp_path, build):
    viewed, bought = shuffled(6, 150, 3_000), shuffled(7, 150, 3_000)
    write_batches(f"{tmp_path}/v", in_files(viewed, 3))
    write_batches(f"{tmp_path}/p", in_files(bought, 3))
    got = run(build(stream(spark, f"{tmp_path}/v", schemas.PAGE_VIEW, 5_000),
                    stream(spark, f"{tmp_path}/p", schemas.PURCHASE, 5_000)), tmp_path)
    columns = ("user_id", "product_id_viewed", "product_id_purchased", "view_ts", "purchase_ts", "amount_usd")
    assert rows(got, *columns) == rows(build(events(spark, viewed), events(spark, bought)), *columns)
    assert got.count() > 0


def test_interval_join_state_is_dropped(spark, tmp_path):
    for side, seed in (("v", 6), ("p", 7)):
        write_batches(f"{tmp_path}/{side}", in_files(shuffled(seed, 150, 3_000), 3) + [FLUSH, [("f", "f", FLUSH[0][2] + 1)]])
    joined = joins.interval_join(stream(spark, f"{tmp_path}/v", schemas.PAGE_VIEW, 5_000),
                                 stream(spark, f"{tmp_path}/p", schemas.PURCHASE, 5_000), 1_500, 4_000)
    query = start(joined, "parquet", f"{tmp_path}/cp", f"{tmp_path}/out", trigger=AVAILABLE_NOW)
    finish(query)
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 6


def test_interval_join_bounds(spark, tmp_path):
    write_batches(f"{tmp_path}/v", [[("a", "v", 100_000)]])
    write_batches(f"{tmp_path}/p", [[("a", "p", t, 1) for t in (69_999, 70_000, 400_000, 400_001)]])
    got = run(joins.interval_join(stream(spark, f"{tmp_path}/v", schemas.PAGE_VIEW, 5_000),
                                  stream(spark, f"{tmp_path}/p", schemas.PURCHASE, 5_000)), tmp_path)
    assert rows(got, "delta_ms") == [(-30_000,), (300_000,)]


BOTH_FORMS = pytest.mark.parametrize("alerts", [rapid_purchases_stream, patterns.rapid_purchases])


@BOTH_FORMS
@pytest.mark.parametrize("min_times,within,ranks", [(3, 4_000, 256), (2, 1_000, 256), (3, 4_000, 2), (5, 9_000, 3)])
def test_bursts_equal_brute_force(spark, monkeypatch, tmp_path, alerts, min_times, within, ranks):
    monkeypatch.setattr(patterns, "RANKS", ranks)
    data = shuffled(8, 300, 4_000)
    write_batches(f"{tmp_path}/in", in_files(data, 6) + [FLUSH])
    got = run(alerts(stream(spark, f"{tmp_path}/in", schemas.PURCHASE, 5_000), min_times, within), tmp_path)
    assert rows(got, *ALERT) == brute_force_runs(data, min_times, within)


@pytest.mark.parametrize("small", [0, 4])
def test_bursts_in_slots(spark, monkeypatch, tmp_path, small):
    """Groups that outgrow one value, at once or over several batches."""
    monkeypatch.setattr(stages, "SMALL", small)
    data = shuffled(8, 300, 4_000)
    write_batches(f"{tmp_path}/in", in_files(data, 6) + [FLUSH])
    got = run(rapid_purchases_stream(stream(spark, f"{tmp_path}/in", schemas.PURCHASE, 5_000), 3, 4_000), tmp_path)
    assert rows(got, *ALERT) == brute_force_runs(data, 3, 4_000)


def test_one_timer_for_what_comes_next(spark, tmp_path):
    write_batches(f"{tmp_path}/in", [[("u", "p", t, 1) for t in (1_000, 2_000, 3_000)]])
    views = lambda: stream(spark, f"{tmp_path}/in", schemas.PURCHASE, 5_000)
    forms = [rapid_purchases_stream(views()), late_sessions.session_changes(views(), 500, 60_000)]
    for k, form in enumerate(forms):
        query = start(form, "parquet", f"{tmp_path}/cp{k}", f"{tmp_path}/out{k}", trigger=AVAILABLE_NOW)
        finish(query)
        assert query.recentProgress[0]["stateOperators"][0]["customMetrics"]["numRegisteredTimers"] == 1


def test_burst_processor_drops_late_rows_and_survives_a_restart(spark, tmp_path):
    def go():
        purchases = stream(spark, f"{tmp_path}/in", schemas.PURCHASE, 5_000)
        return run(rapid_purchases_stream(purchases), tmp_path)

    write_batches(f"{tmp_path}/in", [[("u", "p", 1_000, 1), ("u", "p", 2_000, 2)], [("x", "p", 20_000, 1)]])
    assert go().count() == 0
    # 3000 is behind the watermark of 15000; with it there would be a run of three
    write_batches(f"{tmp_path}/in", [[("u", "p", 3_000, 4), ("u", "p", 30_000, 1), ("u", "p", 31_000, 1)]], first=2)
    assert go().count() == 0
    write_batches(f"{tmp_path}/in", [[("u", "p", 32_000, 5)], FLUSH], first=3)
    assert rows(go(), *ALERT) == [("u", 3, 7.0, 30_000, 32_000)]


def test_burst_state_is_forgotten(spark, tmp_path):
    data = shuffled(9, 60, 2_000, span=60_000)
    write_batches(f"{tmp_path}/in", in_files(data, 3) + [FLUSH, [("flush", "flush", FLUSH[0][2] + 1)]])
    alerts = rapid_purchases_stream(stream(spark, f"{tmp_path}/in", schemas.PURCHASE, 5_000))
    query = start(alerts, "parquet", f"{tmp_path}/cp", f"{tmp_path}/out", trigger=AVAILABLE_NOW)
    finish(query)
    left = [op["customMetrics"] for op in query.lastProgress["stateOperators"]]
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 8, left


@BOTH_FORMS
def test_burst_filter(spark, tmp_path, alerts):
    write_batches(f"{tmp_path}/in", [[("u", "p", 1, 50), ("u", "p", 2, 5), ("u", "p", 3, 50), ("u", "p", 4, 50)], FLUSH])
    purchases = stream(spark, f"{tmp_path}/in", schemas.PURCHASE, 5_000)
    got = run(alerts(purchases, where=F.col("amount_usd") > 20), tmp_path)
    assert rows(got, *ALERT) == [("u", 3, 150.0, 1, 4)]


def test_late_rows_are_dropped(spark, tmp_path):
    write_batches(f"{tmp_path}/in", [[("u", "p", t) for t in ts] for ts in
                                     ([1_000], [15_000], [2_000, 10_500], [3_000], [100_000])])
    counts = windows.tumbling_counts(stream(spark, f"{tmp_path}/in", schemas.PAGE_VIEW, 5_000))
    query = start(counts, "parquet", f"{tmp_path}/cp", f"{tmp_path}/out", trigger=AVAILABLE_NOW)
    finish(query)
    assert rows(spark.read.parquet(f"{tmp_path}/out"), *COUNTS) == [(0, 10_000, 2), (10_000, 20_000, 2)]
    assert sum(int(p["stateOperators"][0]["numRowsDroppedByWatermark"]) for p in query.recentProgress) == 1


def test_late_row_does_not_extend_a_session(spark, tmp_path):
    write_batches(f"{tmp_path}/in", [[("a", "p", 50_000)], [("b", "p", 75_000)], [("c", "p", 75_001)],
                                     [("a", "p", 25_000)], [("z", "p", 500_000)]])
    got = run(windows.session_counts(stream(spark, f"{tmp_path}/in", schemas.PAGE_VIEW, 5_000)), tmp_path)
    assert rows(got.filter("user_id = 'a'"), *COUNTS) == [(50_000, 80_000, 1)]


def test_allowed_lateness_refires_in_update_mode(spark, tmp_path):
    write_batches(f"{tmp_path}/in", [[("u", "p", t)] for t in (1_000, 15_000, 16_000, 2_000, 100_000)])
    counts = windows.tumbling_counts(stream(spark, f"{tmp_path}/in", schemas.PAGE_VIEW, 35_000))
    finish(start(counts, "memory", f"{tmp_path}/cp", output_mode="update", trigger=AVAILABLE_NOW, name="refire"))
    fired = [r["count"] for r in spark.table("refire").filter("window_start_ms = 0").collect()]
    assert fired == [1, 2]


def test_running_counters(spark, tmp_path):
    write_batches(f"{tmp_path}/in", [[("u", "p", 1, 300)], [("u", "p", 2, 5)]])
    bought = stream(spark, f"{tmp_path}/in", schemas.PURCHASE, 0).withColumn("event_type", F.lit("purchase"))
    counters = windows.dashboard_counters(bought, F.col("ts_ms") == 1, F.col("amount_usd") > 200)
    finish(start(counters, "memory", f"{tmp_path}/cp", output_mode="complete", trigger=AVAILABLE_NOW, name="counters"))
    assert rows(spark.table("counters"), "total", "late", "purchases", "flagged") == [(2, 1, 2, 1)]


def test_restart_gives_every_window_once(spark, tmp_path):
    def go():
        return run(windows.tumbling_counts(stream(spark, f"{tmp_path}/in", schemas.PAGE_VIEW, 5_000)), tmp_path)

    write_batches(f"{tmp_path}/in", [[("u", "p", 1_000), ("u", "p", 12_000)]])
    go()
    write_batches(f"{tmp_path}/in", [[("u", "p", 13_000), ("u", "p", 90_000)]], first=1)
    go()
    assert rows(go(), *COUNTS) == [(0, 10_000, 1), (10_000, 20_000, 2)]


def test_malformed_record_stops_the_stream(spark, tmp_path):
    write_batch(f"{tmp_path}/in", 0, as_json([("u", "p", 1)]) + ["{bad"])
    with pytest.raises(Exception, match="malformed record"):
        run(windows.tumbling_counts(stream(spark, f"{tmp_path}/in", schemas.PAGE_VIEW, 0)), tmp_path)


def test_late_side_output(spark, tmp_path):
    write_batches(f"{tmp_path}/in", [[("u", "p", t) for t in ts] for ts in ([15_000], [9_000, 10_000, 40_000], [5_000, 39_000])])
    views = stream(spark, f"{tmp_path}/in", schemas.PAGE_VIEW, 5_000)
    paths = [f"{tmp_path}/{name}" for name in ("kept", "late", "marks")]
    finish(start(views, split_late(*paths), f"{tmp_path}/cp", trigger=AVAILABLE_NOW))
    assert rows(spark.read.parquet(paths[1]), "batch_id", "ts_ms") == [(1, 9_000), (2, 5_000)]
    assert rows(spark.read.parquet(paths[0]), "ts_ms") == sorted([(15_000,), (10_000,), (40_000,), (39_000,)], key=repr)


def test_recent_results_table(spark, tmp_path):
    write_batches(f"{tmp_path}/in", [[("u", "p", t) for t in range(i * 10, i * 10 + 4)] for i in range(3)])
    views = stream(spark, f"{tmp_path}/in", schemas.PAGE_VIEW, 0).select(F.lit("view").alias("type"), "user_id", "ts_ms")
    work = keep_recent(f"{tmp_path}/recent", lambda: [F.desc("ts_ms")], 5)
    finish(start(views, work, f"{tmp_path}/cp", trigger=AVAILABLE_NOW))
    current = spark.read.parquet(f"{tmp_path}/recent/v=2")
    assert rows(current.orderBy("position"), "position", "ts_ms") == [(1, 23), (2, 22), (3, 21), (4, 20), (5, 13)]


def test_batches_can_be_run_again(spark, tmp_path):
    """A micro-batch that is repeated after a failure overwrites what it wrote."""
    first = events(spark, [("u", "p", 15_000)]).withColumn("type", F.lit("view"))
    second = events(spark, [("u", "p", 9_000), ("u", "p", 40_000)]).withColumn("type", F.lit("view"))
    paths = [f"{tmp_path}/{name}" for name in ("kept", "late", "marks")]
    recent, split = keep_recent(f"{tmp_path}/recent", lambda: [F.desc("ts_ms")], 2), split_late(*paths)
    for work in (recent, split):
        for batch_id, batch in [(0, first), (0, first), (1, second), (1, second)]:
            work(batch, batch_id)
    assert rows(spark.read.parquet(f"{tmp_path}/recent/v=1"), "ts_ms") == [(15_000,), (40_000,)]
    assert rows(spark.read.parquet(paths[1]), "ts_ms") == [(9_000,)]
    assert rows(spark.read.parquet(paths[0]), "ts_ms") == [(15_000,), (40_000,)]


def test_keyed_counter_resumes_from_its_checkpoint(spark, tmp_path):
    latest = {}

    def keep(batch, batch_id):
        latest.update({r["user_id"]: r["n"] for r in batch.collect()})

    def go():
        counter = stream(spark, f"{tmp_path}/in", schemas.PAGE_VIEW, 0).groupBy("user_id").agg(F.count("*").alias("n"))
        finish(start(counter, keep, f"{tmp_path}/cp", output_mode="update", trigger=AVAILABLE_NOW))

    write_batches(f"{tmp_path}/in", [[("a", "p", 1), ("b", "p", 2)], [("a", "p", 3)]])
    go()
    assert latest == {"a": 2, "b": 1}
    latest.clear()
    write_batches(f"{tmp_path}/in", [[("a", "p", 4), ("c", "p", 5)]], first=2)
    go()
    # only what changed is emitted, with the counts of before the restart
    assert latest == {"a": 3, "c": 1}


def test_stream_dedup_of_repeated_results(spark, tmp_path):
    write_batches(f"{tmp_path}/in", [[("u", "p", 1_000)], [("u", "p", 1_000), ("v", "p", 1_000)], [("u", "p", 2_000)]])
    seen = stream(spark, f"{tmp_path}/in", schemas.PAGE_VIEW, 5_000).select(
        F.lit("session").alias("kind"), F.col("ts_ms").alias("window_start_ms"), "user_id", "ts")
    got = run(results.dedup_windows(seen), tmp_path)
    assert rows(got, "window_start_ms", "user_id") == [(1_000, "u"), (1_000, "v"), (2_000, "u")]


@pytest.mark.parametrize("slow,want", [([1_000], []), ([1_000, 45_000], [(0, 10_000, 1)])])
def test_two_sources_wait_for_the_slower_watermark(spark, tmp_path, slow, want):
    write_batches(f"{tmp_path}/fast", [[("u", "p", 50_000)]])
    write_batches(f"{tmp_path}/slow", [[("u", "p", t)] for t in slow])
    both = (stream(spark, f"{tmp_path}/fast", schemas.PAGE_VIEW, 0)
            .unionByName(stream(spark, f"{tmp_path}/slow", schemas.PAGE_VIEW, 0)))
    assert rows(run(windows.tumbling_counts(both), tmp_path), *COUNTS) == want
