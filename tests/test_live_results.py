"""Concurrency, rank movement and alerts of new accounts on streams, against the same on tables."""

import random

import pytest

from tests.helpers import events, rows, run, stream, write_batches
from tests.test_streams import FLUSH, in_files, shuffled
from wakeline import schemas
from wakeline.operators import patterns, results, topk, windows
from wakeline.streaming import accounts, concurrency, movement
from wakeline.streaming.bursts import rapid_purchases_stream

OPEN = ("at_ms", "open")
PLACE = ("window_start_ms", "rank", "product_id", "prev_rank", "movement")
AGED = ("user_id", "purchase_count", "total_amount_usd", "first_ts", "last_ts", "account_age_ms")


def feed(tmp_path, parts, name="in"):
    write_batches(f"{tmp_path}/{name}", [*parts, FLUSH])
    return f"{tmp_path}/{name}"


@pytest.mark.parametrize("chunk", [1_000, 7_000, 1_000_000])
def test_concurrency_of_sessions(spark, tmp_path, chunk):
    data = shuffled(7, 150, 3_000, users=6)
    folder = feed(tmp_path, in_files(data, 4))
    got = run(concurrency.concurrent_sessions(stream(spark, folder, schemas.PAGE_VIEW, 3_000), 2_500, chunk), tmp_path)
    want = results.concurrency(windows.session_counts(events(spark, data), 2_500))
    assert rows(got, *OPEN) == rows(want, *OPEN)


def test_moments_of_sessions(spark, tmp_path):
    # a's first session ends where b begins, on the border of a chunk; c spans three chunks without an event of others;
    # d joins two sessions by a row that comes last; events exactly a gap apart merge; a null user is one user
    data = [("a", "p", 500), ("b", "p", 1_000), ("c", "p", 5_100), ("c", "p", 5_600), ("c", "p", 6_100), ("c", "p", 6_600), ("c", "p", 7_100),
            ("d", "p", 9_000), ("d", "p", 9_800), (None, "p", 12_000), (None, "p", 12_100), ("d", "p", 9_400)]
    folder = feed(tmp_path, [data[:6], data[6:11], data[11:]])
    got = run(concurrency.concurrent_sessions(stream(spark, folder, schemas.PAGE_VIEW, 4_000), 500, 1_000), tmp_path)
    want = [(500, 1), (1_000, 1), (1_500, 0), (5_100, 1), (7_600, 0), (9_000, 1), (10_300, 0), (12_000, 1), (12_600, 0)]
    assert rows(got, *OPEN) == sorted(want, key=repr)


def test_concurrency_goes_on_after_a_restart(spark, tmp_path):
    data = shuffled(8, 120, 2_000, users=3)
    parts = in_files(data, 4)
    folder = f"{tmp_path}/in"
    write_batches(folder, parts[:2])
    build = lambda: concurrency.concurrent_sessions(stream(spark, folder, schemas.PAGE_VIEW, 2_000), 9_000, 4_000)
    run(build(), tmp_path)
    write_batches(folder, parts[2:] + [FLUSH], first=2)
    want = results.concurrency(windows.session_counts(events(spark, data), 9_000))
    assert rows(run(build(), tmp_path), *OPEN) == rows(want, *OPEN)


@pytest.mark.parametrize("size,slide,chunk", [(10_000, None, 30_000), (10_000, None, 10_000), (20_000, 5_000, 15_000)])
def test_rank_movement(spark, tmp_path, size, slide, chunk):
    # no events in 40 to 70 s: windows without a board, and whole chunks
    data = [e for e in shuffled(9, 300, 3_000) if not 40_000 <= e[2] < 70_000] + [("u", None, 100_000), ("u", None, 100_001)]
    data.sort(key=lambda e: e[2])
    folder = feed(tmp_path, in_files(data, 5))
    views = stream(spark, folder, schemas.PAGE_VIEW, 3_000)
    got = run(movement.rank_movement_stream(views, 4, size, slide, chunk), tmp_path)
    # the schema takes rows without a product for views, too
    want = topk.rank_movement(topk.topk_products(events(spark, data), 4, size, slide), 1_000_000)
    assert rows(got, *PLACE) == rows(want, *PLACE)
    assert want.filter("movement != 0").count() and want.filter("prev_rank IS NULL").count()


def test_rank_movement_over_a_restart(spark, tmp_path):
    data = sorted(shuffled(10, 200, 1_000), key=lambda e: e[2])
    parts = in_files(data, 4)
    folder = f"{tmp_path}/in"
    write_batches(folder, parts[:2])
    build = lambda: movement.rank_movement_stream(stream(spark, folder, schemas.PAGE_VIEW, 0), 3, 10_000, chunk=20_000)
    run(build(), tmp_path)
    write_batches(folder, parts[2:] + [FLUSH], first=2)
    want = topk.rank_movement(topk.topk_products(events(spark, data), 3, 10_000), 1_000_000)
    assert rows(run(build(), tmp_path), *PLACE) == rows(want, *PLACE)


def young(spark, purchases, views, max_age, known=None, settle=7_000):
    alerts = rapid_purchases_stream(stream(spark, purchases, schemas.PURCHASE, 3_000), 3, 6_000, timed=True)
    return accounts.new_account_bursts_stream(alerts, stream(spark, views, schemas.PAGE_VIEW, 3_000), max_age, known, settle)


def bought_and_seen(seed):
    rng = random.Random(seed)
    bought = shuffled(seed, 250, 3_000, users=9)
    first = {u: min(e[2] for e in bought if e[0] == u) for u in {e[0] for e in bought}}
    # some users are seen long before they buy, one just before; every purchase is activity too
    seen = [(u, "p", max(t - rng.choice([10, 20_000, 50_000]), 0)) for u, t in first.items()] + [(u, p, t) for u, p, t, _ in bought]
    return bought, sorted(seen, key=lambda e: e[2])


def test_new_accounts(spark, tmp_path):
    bought, seen = bought_and_seen(11)
    # files pair by pair, so that one topic may be ahead of the other
    purchases, views = feed(tmp_path, in_files(bought, 4), "bought"), feed(tmp_path, in_files(seen, 6), "seen")
    want = patterns.new_account_bursts(patterns.rapid_purchases(events(spark, bought), 3, 6_000), events(spark, seen), 40_000)
    assert 0 < want.count() < patterns.rapid_purchases(events(spark, bought), 3, 6_000).count()
    assert rows(run(young(spark, purchases, views, 40_000), tmp_path), *AGED) == rows(want, *AGED)


def test_accounts_known_before_and_a_restart(spark, tmp_path):
    bought, seen = bought_and_seen(12)
    known = [("u0", "p", -500_000), ("u1", "p", -10), ("u1", "p", 90_000), (None, "p", 0), ("nobody", "p", 5)]
    b, s = in_files(bought, 4), in_files(seen, 4)
    purchases, views = f"{tmp_path}/bought", f"{tmp_path}/seen"
    write_batches(purchases, b[:2])
    write_batches(views, s[:2])
    build = lambda: young(spark, purchases, views, 60_000, events(spark, known).select("user_id", "ts"))
    run(build(), tmp_path)
    write_batches(purchases, b[2:] + [FLUSH], first=2)
    write_batches(views, s[2:] + [FLUSH], first=2)
    got = rows(run(build(), tmp_path), *AGED)
    want = patterns.new_account_bursts(patterns.rapid_purchases(events(spark, bought), 3, 6_000), events(spark, seen + known), 60_000)
    assert got == rows(want, *AGED) and got
    assert not any(r[0] == "u0" for r in got)


def test_runs_need_two_events(spark):
    with pytest.raises(ValueError):
        rapid_purchases_stream(events(spark, []), 1)


def test_emitted_times_do_not_depend_on_the_zone(spark, tmp_path):
    data = shuffled(13, 80, 2_000, users=3)
    folder = feed(tmp_path, in_files(data, 3))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        got = run(concurrency.concurrent_sessions(stream(spark, folder, schemas.PAGE_VIEW, 2_000), 3_000, 5_000), tmp_path)
        want = results.concurrency(windows.session_counts(events(spark, data), 3_000))
        assert rows(got, *OPEN) == rows(want, *OPEN)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)

