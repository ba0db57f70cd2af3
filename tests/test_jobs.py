"""The standing jobs end to end: JSON files in, JSON files out."""

import json
import os

import pytest

from tests.helpers import write_batches
from tests.test_fixtures import VIEWS
from wakeline import schemas
from wakeline.operators import codec
from wakeline.plans import jobs
from wakeline.sources import messages
from wakeline.streaming.run import AVAILABLE_NOW, finish, start

FLUSH = [("flush", "flush", 10_000_000)]


def raw(spark, folder):
    return messages.files(spark, folder, max_files_per_trigger=1)


def results(spark, tmp, branches):
    finish(*jobs.launch(branches, "json", f"{tmp}/cp", f"{tmp}/out", trigger=AVAILABLE_NOW))
    found = {}
    for topic in branches:
        parts = [f"{tmp}/out/{topic}/{f}" for f in os.listdir(f"{tmp}/out/{topic}") if f.endswith(".json")]
        found[topic] = sorted((json.loads(line) for part in parts for line in open(part)), key=str)
    return found


def test_topk_job(spark, tmp_path):
    write_batches(f"{tmp_path}/in", [VIEWS[:-1], FLUSH])
    got = results(spark, tmp_path, jobs.topk_job(raw(spark, f"{tmp_path}/in"), 3, 60_000))
    assert got == {"results.topk": [{"window_start_ms": 0, "window_end_ms": 60_000, "top": [
        {"product_id": "A", "count": 10}, {"product_id": "B", "count": 6}, {"product_id": "C", "count": 3}]}]}


def test_window_stats_job(spark, tmp_path):
    write_batches(f"{tmp_path}/in", [[("u", "p", t) for t in (1_000, 2_000, 65_000)], FLUSH])
    got = results(spark, tmp_path, jobs.window_stats_job(raw(spark, f"{tmp_path}/in")))
    assert [(r["window_start_ms"], r["count"]) for r in got["results.windows.tumbling"]] == [(0, 2), (60_000, 1)]
    assert len(got["results.windows.sliding"]) == 6
    assert got["results.windows.sessions"] == [
        {"kind": "session", "window_start_ms": 1_000, "window_end_ms": 32_000, "count": 2, "user_id": "u"},
        {"kind": "session", "window_start_ms": 65_000, "window_end_ms": 95_000, "count": 1, "user_id": "u"}]


def test_window_stats_in_one_query(spark, tmp_path):
    write_batches(f"{tmp_path}/in", [[("u", "p", t) for t in (1_000, 2_000, 65_000)], FLUSH])
    finish(jobs.launch_window_stats(raw(spark, f"{tmp_path}/in"), f"{tmp_path}/cp", f"{tmp_path}/out", trigger=AVAILABLE_NOW))
    read = lambda topic: spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/out/{topic}").orderBy("window_start_ms").collect()
    assert [(r["window_start_ms"], r["count"]) for r in read("results.windows.tumbling")] == [(0, 2), (60_000, 1)]
    assert len(read("results.windows.sliding")) == 6
    assert [(r["window_start_ms"], r["window_end_ms"], r["user_id"]) for r in read("results.windows.sessions")] == [
        (1_000, 32_000, "u"), (65_000, 95_000, "u")]


def test_join_job(spark, tmp_path):
    write_batches(f"{tmp_path}/v", [[("a", "x", 100_000)]])
    write_batches(f"{tmp_path}/p", [[("a", "y", 70_000, 9.5), ("a", "y", 400_001, 1)]])
    got = results(spark, tmp_path, jobs.join_job(raw(spark, f"{tmp_path}/v"), raw(spark, f"{tmp_path}/p")))
    assert got["results.joins"] == [{"user_id": "a", "product_id_viewed": "x", "product_id_purchased": "y",
                                     "view_ts": 100_000, "purchase_ts": 70_000, "delta_ms": -30_000, "amount_usd": 9.5}]


@pytest.mark.parametrize("immediate", [False, True])
def test_fraud_job(spark, tmp_path, immediate):
    write_batches(f"{tmp_path}/in", [[("u", "p", t, 1.5) for t in (1_000, 2_000, 10_999)], FLUSH])
    got = results(spark, tmp_path, jobs.fraud_job(raw(spark, f"{tmp_path}/in"), immediate=immediate))
    assert got["results.fraud"] == [{"user_id": "u", "purchase_count": 3, "total_amount_usd": 4.5,
                                     "first_ts": 1_000, "last_ts": 10_999, "span_ms": 9_999}]


def test_layouts_match_the_schemas(spark, tmp_path):
    write_batches(f"{tmp_path}/in", [FLUSH])
    source = raw(spark, f"{tmp_path}/in")

    def fields(schema):
        return [(f.name, f.dataType.simpleString()) for f in schema]

    assert fields(jobs.topk_job(source)["results.topk"].schema) == fields(schemas.TOPK_RESULT)
    for df in jobs.window_stats_job(source).values():
        assert fields(df.schema) == fields(schemas.WINDOW_RESULT)
    assert fields(jobs.join_job(source, source)["results.joins"].schema) == fields(schemas.MATCH)
    assert fields(jobs.fraud_job(source)["results.fraud"].schema) == fields(schemas.ALERT)


def test_kafka_needs_its_connector(spark, tmp_path):
    """No connector here: both ends must get as far as asking for it."""
    with pytest.raises(Exception, match="(?i)kafka"):
        messages.kafka(spark, "localhost:1", [jobs.VIEWS_TOPIC, jobs.PURCHASES_TOPIC])
    write_batches(f"{tmp_path}/in", [FLUSH])
    views = codec.decode(raw(spark, f"{tmp_path}/in"), schemas.PAGE_VIEW)
    with pytest.raises(Exception, match="(?i)kafka"):
        start(views, "kafka", f"{tmp_path}/cp", "results.topk", trigger=AVAILABLE_NOW)
