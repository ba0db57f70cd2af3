"""Results that change after they were given, several results of one read, counts over a whole run."""

import os

import pytest
from pyspark.sql import functions as F

from tests.helpers import as_json, events, rows, stream, write_batch, write_batches
from tests.test_streams import in_files, shuffled
from wakeline import schemas
from wakeline.operators import windows
from wakeline.streaming import fanout, late_sessions, progress, refiring
from wakeline.streaming.run import AVAILABLE_NOW, finish, start

COUNTS = ("window_start_ms", "window_end_ms", "count")
FLUSH = [("flush", "flush", 10_000_000)]


def forget_last_commit(tmp):
    """As if the query had been stopped between its sink and its commit: the batch runs again."""
    commits = f"{tmp}/cp/commits"
    last = max(int(f) for f in os.listdir(commits) if f.isdigit())
    os.remove(f"{commits}/{last}")
    os.remove(f"{commits}/.{last}.crc")


def refire(spark, tmp, batches, delay=5_000, lateness=20_000, **kwargs):
    write_batches(f"{tmp}/in", batches)
    views = stream(spark, f"{tmp}/in", schemas.PAGE_VIEW, delay + lateness)
    finish(start(refiring.refiring_counts(views, **kwargs), refiring.upsert(f"{tmp}/table", delay), f"{tmp}/cp",
                 output_mode="update", trigger=AVAILABLE_NOW))


def test_a_window_fires_again_for_late_rows(spark, tmp_path):
    at = lambda *ts: [("u", "p", t) for t in ts]
    # the window 0-10 s closes behind 15 s, is changed at 2 s and 3 s, and takes no more a batch after 35 s are passed
    refire(spark, tmp_path, [at(1_000), at(16_000), at(2_000, 3_000), at(36_000), at(36_001), at(4_000), at(41_000, 12_000)])
    shown = lambda until=None: rows(refiring.firings(spark, f"{tmp_path}/table", until=until), *COUNTS, "firing")
    first = shown()
    assert [r for r in first if r[0] == 0] == [(0, 10_000, 1, 1), (0, 10_000, 3, 2)]
    assert [r for r in first if r[0] == 10_000] == [(10_000, 20_000, 1, 1), (10_000, 20_000, 2, 2)]
    assert rows(refiring.current(spark, f"{tmp_path}/table"), *COUNTS, "firings") == [
        (0, 10_000, 3, 2), (10_000, 20_000, 2, 2)]
    # an open window is not shown, and neither is what came after a version
    assert shown(0) == [] and shown(1) == [(0, 10_000, 1, 1)]
    assert not [r for r in first if r[0] >= 30_000]


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    data = shuffled(11, 200, 9_000, 60_000)
    refire(spark, tmp_path, in_files(data, 5) + [FLUSH], delay=2_000, lateness=10_000)
    before = rows(refiring.firings(spark, f"{tmp_path}/table", delay=2_000), *COUNTS, "firing")
    forget_last_commit(tmp_path)
    views = stream(spark, f"{tmp_path}/in", schemas.PAGE_VIEW, 12_000)
    finish(start(refiring.refiring_counts(views), refiring.upsert(f"{tmp_path}/table", 2_000), f"{tmp_path}/cp",
                 output_mode="update", trigger=AVAILABLE_NOW))
    assert rows(refiring.firings(spark, f"{tmp_path}/table", delay=2_000), *COUNTS, "firing") == before
    final = rows(refiring.current(spark, f"{tmp_path}/table", delay=2_000), *COUNTS)
    assert final == rows(windows.tumbling_counts(events(spark, data)), *COUNTS)


def test_firings_by_product(spark, tmp_path):
    data = shuffled(12, 150, 8_000, 40_000)
    refire(spark, tmp_path, in_files(data, 4) + [FLUSH], delay=1_000, lateness=10_000, keys=("product_id",))
    got = refiring.current(spark, f"{tmp_path}/table", ("product_id",), 1_000)
    assert rows(got, *COUNTS, "product_id") == rows(windows.counts_by_product(events(spark, data)), *COUNTS, "product_id")


# --- sessions ---------------------------------------------------------------------------------------

SESSION = ("user_id", *COUNTS)


def sessions(spark, tmp, batches, gap, delay, lateness):
    write_batches(f"{tmp}/in", batches)
    views = stream(spark, f"{tmp}/in", schemas.PAGE_VIEW, delay + lateness)
    query = start(late_sessions.session_changes(views, gap, lateness), "parquet", f"{tmp}/cp", f"{tmp}/out", trigger=AVAILABLE_NOW)
    finish(query)
    return spark.read.parquet(f"{tmp}/out"), query


def test_a_late_row_joins_two_sessions(spark, tmp_path):
    at = lambda user, *ts: [(user, "p", t) for t in ts]
    changes, query = sessions(spark, tmp_path, [
        at("a", 1_000, 8_000), at("z", 30_000), at("z", 30_001), at("a", 4_500), at("a", 20_000), at("z", 60_000), at("z", 60_001), at("a", 21_000), FLUSH],
        gap=4_000, delay=5_000, lateness=25_000)
    got = [r for r in rows(changes, *SESSION, "retracted") if r[0] == "a"]
    assert got == sorted([
        ("a", 1_000, 5_000, 1, False), ("a", 8_000, 12_000, 1, False),  # closed behind 25 s
        ("a", 1_000, 5_000, 1, True), ("a", 8_000, 12_000, 1, True), ("a", 1_000, 12_000, 3, False),  # 4.5 s joins both
        ("a", 20_000, 24_000, 1, False)], key=repr)  # a late row of its own; 21 s came too late
    assert [r for r in rows(late_sessions.standing(changes), *SESSION) if r[0] == "a"] == [("a", 1_000, 12_000, 3), ("a", 20_000, 24_000, 1)]
    # only the user of the flush is still held
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3


@pytest.mark.parametrize("seed,lateness", [(1, 20_000), (2, 6_000), (3, 0)])
def test_sessions_in_the_end(spark, tmp_path, seed, lateness):
    """Whatever came late within the bound, the standing sessions are those of the whole table."""
    delay = 6_000 if lateness < 6_000 else 1_000
    data = shuffled(seed, 250, 6_000, 90_000)
    changes, _ = sessions(spark, tmp_path, in_files(data, 5) + [FLUSH, [("flush", "flush", 20_000_000)]], 3_000, delay, lateness)
    want = rows(windows.session_counts(events(spark, data), 3_000), *SESSION)
    assert [r for r in rows(late_sessions.standing(changes), *SESSION) if r[0] != "flush"] == want
    assert lateness or not changes.filter("retracted").count()


# --- one read, three results ------------------------------------------------------------------------

KINDS = ("tumbling", "sliding", "session")
RESULT = ("window_start_ms", "window_end_ms", "count", "user_id")


def three(spark, tmp):
    views = stream(spark, f"{tmp}/in", schemas.PAGE_VIEW, 4_000)
    sink = fanout.route({kind: f"{tmp}/out/{kind}" for kind in KINDS})
    query = start(fanout.window_stats(views, 10_000, 30_000, 4_000), sink, f"{tmp}/cp", trigger=AVAILABLE_NOW)
    finish(query)
    return sum(p["numInputRows"] for p in query.recentProgress), len(query.lastProgress["sources"])


def results(spark, tmp, kind):
    read = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp}/out/{kind}")
    return [r for r in rows(read, *RESULT) if r[3] != "flush" and r[0] < 9_000_000]


def test_three_results_of_one_read(spark, tmp_path):
    data = shuffled(21, 300, 3_000)
    batches = in_files(data, 6)
    write_batches(f"{tmp_path}/in", batches[:4])
    read, sources = three(spark, tmp_path)
    assert (read, sources) == (sum(map(len, batches[:4])), 1)
    # stopped after the sinks had written and before the batch was committed
    forget_last_commit(tmp_path)
    write_batches(f"{tmp_path}/in", batches[4:] + [FLUSH], first=4)
    three(spark, tmp_path)
    table = events(spark, data)
    nobody = F.lit(None).cast("string").alias("user_id")
    assert results(spark, tmp_path, "tumbling") == rows(windows.tumbling_counts(table).select(*COUNTS, nobody), *RESULT)
    assert results(spark, tmp_path, "sliding") == rows(windows.sliding_counts(table).select(*COUNTS, nobody), *RESULT)
    assert results(spark, tmp_path, "session") == rows(windows.session_counts(table, 4_000), *RESULT)


def test_windows_on_their_borders(spark, tmp_path):
    """Neighbouring windows do not run into each other, and sessions exactly a gap apart do."""
    data = [("a", "p", t) for t in (0, 9_999, 10_000, 20_000, 29_999)] + [("b", "p", 0), ("b", "p", 4_000), ("b", "p", 8_001)]
    write_batches(f"{tmp_path}/in", [data, FLUSH])
    three(spark, tmp_path)
    assert [r[:3] for r in results(spark, tmp_path, "tumbling")] == [(0, 10_000, 5), (10_000, 20_000, 1), (20_000, 30_000, 2)]
    assert [r[:3] for r in results(spark, tmp_path, "session") if r[3] == "b"] == [(0, 8_000, 2), (8_001, 12_001, 1)]
    assert results(spark, tmp_path, "sliding")[:2] == [(-10_000, 20_000, 6, None), (-20_000, 10_000, 5, None)]


# --- counts over a run ------------------------------------------------------------------------------

def test_dropped_rows_of_more_batches_than_spark_remembers(spark, tmp_path):
    batches = 104
    for k in range(batches):
        late = [("u", "p", 1)] if k > 1 else []
        write_batch(f"{tmp_path}/in", k, as_json([("u", "p", 1_000_000 + 20_000 * k), *late]))
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    listener = progress.watch(spark, f"{tmp_path}/progress")
    try:
        counts = windows.tumbling_counts(stream(spark, f"{tmp_path}/in", schemas.PAGE_VIEW, 5_000))
        query = start(counts, "noop", f"{tmp_path}/cp", trigger=AVAILABLE_NOW)
        finish(query)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    finally:
        spark.streams.removeListener(listener)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    run, seen, dropped = progress.dropped_by_watermark(spark, f"{tmp_path}/progress").first()
    assert run == str(query.runId) and seen >= batches and dropped == batches - 2
    assert progress.reports(spark, f"{tmp_path}/progress").agg(F.sum("input_rows")).first()[0] == 2 * batches - 2
    assert len(query.recentProgress) <= 100
