"""Aggregates of the user's own, and boards and funnels on streams."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.helpers import events, rows, run, stream, write_batches
from tests.test_streams import FLUSH, in_files, shuffled
from wakeline import schemas
from wakeline.operators import custom, joins, topk


class Longest:
    """The longest product name and how many rows were seen; not a built-in aggregate."""

    def create(self):
        return ("", 0)

    def add(self, state, part):
        names = [n for n in part.column("product_id").to_pylist() if n]
        return max([state[0], *names], key=lambda n: (len(n), n)), state[1] + part.num_rows

    def merge(self, left, right):
        return max(left[0], right[0], key=lambda n: (len(n), n)), left[1] + right[1]

    def result(self, state):
        return state


@pytest.mark.parametrize("room", [10_000, 2])
def test_create_add_merge_result(spark, room):
    data = [(None if i % 7 == 0 else f"u{i % 5}", None if i % 11 == 0 else "p" * (i % 13), i) for i in range(500)]
    frame = events(spark, data).repartition(6)
    got = custom.aggregate(frame, {"user_id": F.col("user_id"), "even": F.col("ts_ms") % 2 == 0}, {"product_id": F.col("product_id")}, Longest(),
                           "longest string, n bigint", room)
    want = {}
    for user, product, t in data:
        longest, n = want.get((user, t % 2 == 0), ("", 0))
        want[user, t % 2 == 0] = (max(longest, product or "", key=len), n + 1)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(*k, *v) for k, v in want.items()], key=repr)
    assert custom.aggregate(frame.limit(0), {"k": F.col("user_id")}, {"product_id": F.col("product_id")}, Longest(), "a string, b bigint").collect() == []


def test_one_row_per_task_and_key(spark):
    """What is shuffled are the tasks' states, and the merging step holds one state at a time."""
    frame = spark.range(0, 100_000, 1, 5).select((F.col("id") % 3).alias("k"), (F.col("id") % 10).cast("double").alias("amount_usd"))
    got = custom.aggregate(frame, {"k": F.col("k")}, {"amount_usd": F.col("amount_usd")}, custom.Quantile(0.5, "amount_usd"), "value double, n bigint")
    parts = [sorted(float(i % 10) for i in range(100_000) if i % 3 == k) for k in range(3)]
    assert sorted(map(tuple, got.collect())) == [(k, p[(len(p) + 1) // 2 - 1], len(p)) for k, p in enumerate(parts)]
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("MapInArrow") == 2 and "FlatMapGroups" not in plan


def test_quantile_of_nulls(spark):
    frame = events(spark, [("u", "p", 1, 5.0), ("u", "p", 2, 7.0), ("u", "p", 20_000, 1.0)]).withColumn(
        "amount_usd", F.when(F.col("ts_ms") < 10_000, F.col("amount_usd")))
    assert rows(custom.quantile_per_window(frame, 0.5, 10_000), "*") == [(0, 10_000, 5.0, 2), (20_000, 30_000, None, 0)]


def test_approximate_board(spark, tmp_path):
    """Counts and unlisted products keep within the bound, with far more products than the sketch tracks."""
    rng = random.Random(9)
    data = [("u", f"p{int(rng.paretovariate(0.8)) % 3000}", rng.randrange(10_000)) for _ in range(6_000)]
    write_batches(f"{tmp_path}/in", [*in_files(data, 3), FLUSH])
    board = run(topk.topk_approx_stream(stream(spark, f"{tmp_path}/in", schemas.PAGE_VIEW, 20_000), 60, 10_000, tracked=200), tmp_path)
    true = Counter(p for _, p, _ in data)
    got = [r for r in board.collect() if r["window_start_ms"] == 0]
    bound = got[0]["error_max"]
    assert [r["rank"] for r in got] == list(range(1, 61)) and bound == 6_000 * 7 // 1024
    assert all(true[r["product_id"]] <= r["count"] <= true[r["product_id"]] + bound for r in got)
    least = got[-1]["count"]
    listed = {r["product_id"] for r in got}
    assert all(n <= max(bound, least) for p, n in true.items() if p not in listed)
    assert got[0]["product_id"] == true.most_common(1)[0][0]


def test_a_sketch_does_not_grow_with_products(spark):
    size = {}
    for name, products in (("few", 2_000), ("many", 20_000)):
        data = [("u", f"product-{i % products:06d}", i % 10_000) for i in range(20_000)]
        sketch = events(spark, data).agg(F.expr("approx_top_k_accumulate(product_id, 100)").alias("s"))
        size[name] = sketch.select(F.length("s.sketch")).first()[0]
    assert size["many"] <= 1.2 * size["few"]


@pytest.mark.parametrize("files", [1, 5])
def test_funnel_on_a_stream(spark, tmp_path, files):
    views, bought = shuffled(31, 200, 4_000), shuffled(32, 80, 4_000)
    views += [("nobody", "p", 50_000), ("u0", "p", 60_000), ("u0", "p", 60_000)]
    for name, data in (("v", views), ("p", bought)):
        data.sort(key=lambda e: e[2])
        write_batches(f"{tmp_path}/{name}", in_files(data, files) + [FLUSH, [("flush", "flush", 20_000_000)]])
    found = joins.funnel_stream(stream(spark, f"{tmp_path}/v", schemas.PAGE_VIEW, 5_000), stream(spark, f"{tmp_path}/p", schemas.PURCHASE, 5_000), 3_000)
    got = run(found, tmp_path).filter("view_ts < 9000000")
    times = sorted((u, t) for u, _, t, *_ in bought)
    want = {}
    for u, _, t, *_ in views:
        n, _ = want.get((u, t), (0, None))
        want[u, t] = (n + 1, next((x for w, x in times if w == u and t <= x <= t + 3_000), None))
    assert rows(got, "*") == sorted([(u, t, n, x) for (u, t), (n, x) in want.items()], key=repr)
    assert rows(joins.funnel_totals(got), "*") == rows(joins.funnel(events(spark, views), events(spark, bought), 3_000), "*")
