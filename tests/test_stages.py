"""Patterns with a condition per stage, on tables and streams, against all sub-sequences spelled out."""

import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import events, rows, run, stream, write_batches
from tests.test_streams import in_files
from wakeline import schemas
from wakeline.operators import patterns, stages

ALERT = ("user_id", "purchase_count", "total_amount_usd", "first_ts", "last_ts", "span_ms")


def kinds():
    return F.col("amount_usd") < 20, F.col("amount_usd") >= 10



def plain(data, min_more, within, first=lambda a: a < 20, more=lambda a: a >= 10):
    out = []
    for user in {d[0] for d in data}:
        mine = sorted(((t, p, a) for u, p, t, a in data if u == user))
        for i, (t, _, a) in enumerate(mine):
            if not first(a):
                continue
            count, total = 1, round(a * 100)
            for t2, _, a2 in mine[i + 1:]:
                if t2 - t >= within:
                    break
                if more(a2):
                    count, total = count + 1, total + round(a2 * 100)
                    if count > min_more:
                        out.append((user, count, total / 100, t, t2, t2 - t))
    return sorted(out, key=repr)


def some(seed, n=300, span=60_000, users=3):
    rng = random.Random(seed)
    return [(f"u{rng.randrange(users)}", f"p{rng.randrange(6)}", rng.randrange(span), rng.randrange(3000) / 100) for _ in range(n)]


@pytest.mark.parametrize("seed,min_more,within", [(1, 2, 1000), (2, 1, 500), (3, 3, 2500)])
def test_table(spark, seed, min_more, within):
    data = some(seed)
    assert rows(stages.staged_purchases(events(spark, data), *kinds(), min_more, within), *ALERT) == plain(data, min_more, within)


def test_groups_of_first_events(spark, monkeypatch):
    monkeypatch.setattr(stages, "RANKS", 3)
    data = some(4, 150, 8_000, 1) + [("u0", "p", 900, 15.0)] * 3
    assert rows(stages.staged_purchases(events(spark, data), *kinds(), 2, 1500), *ALERT) == plain(data, 2, 1500)


def test_ties_and_events_of_both_kinds(spark):
    """Equal times are ranked by product; an event of both kinds does not continue what it begins."""
    data = [("u", "a", 0, 15.0), ("u", "b", 0, 15.0), ("u", "c", 0, 5.0), ("u", "d", 0, 25.0), ("u", "e", 10, 25.0),
            ("v", "a", 5, 15.0), ("v", "b", 5, 15.0), ("w", "a", 5, 15.0), ("w", "b", 6, 5.0)]
    got = rows(stages.staged_purchases(events(spark, data), *kinds(), 1, 10), *ALERT)
    assert got == plain(data, 1, 10)
    assert ("v", 2, 30.0, 5, 5, 0) in got and not [r for r in got if r[0] == "w"]


def test_nulls_and_an_empty_table(spark):
    data = [("u", None, 0, 5.0), ("u", None, 1, 15.0), ("u", "p", 2, 15.0), (None, "p", 3, 5.0)]
    frame = events(spark, data).unionByName(events(spark, [("u", "p", 1, 0.0)]).withColumn("amount_usd", F.lit(None).cast("double")))
    assert rows(stages.staged_purchases(frame, *kinds(), 2, 1000), *ALERT) == [("u", 3, 35.0, 0, 2, 2)]
    assert stages.staged_purchases(frame.limit(0), *kinds()).collect() == []


def test_both_conditions_true(spark):
    frame, yes = events(spark, some(5, 200)), F.lit(True)
    assert rows(stages.staged_purchases(frame, yes, yes, 2, 1500), *ALERT) == rows(patterns.rapid_purchases(frame, 3, 1500), *ALERT)


@pytest.mark.parametrize("files", [1, 6])
def test_stream(spark, tmp_path, files):
    rng = random.Random(7)
    data = sorted(some(6, 250, 40_000) + [("u0", "p", 900, 15.0)] * 2, key=lambda e: e[2] + rng.randrange(3_000))
    write_batches(f"{tmp_path}/in", in_files(data, files) + [[("flush", "flush", 10_000_000)]])
    bought = stream(spark, f"{tmp_path}/in", schemas.PURCHASE, 3_000)
    assert rows(run(stages.staged_purchases(bought, *kinds(), 2, 2_000), tmp_path), *ALERT) == plain(data, 2, 2_000)
