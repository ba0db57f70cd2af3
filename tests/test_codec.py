"""Decoding, encoding and routing of JSON messages."""

import json

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from wakeline import schemas
from wakeline.operators import codec
from wakeline.sources import messages


def test_missing_and_unknown_fields(spark):
    raw = messages.rows(spark, ['{"user_id":"u","ts_ms":12,"x":1}', '{"user_id":"u"}', '{"user_id":"u","ts_ms":"12"}'])
    got = codec.decode(raw, schemas.PAGE_VIEW, fallback=F.timestamp_millis(F.lit(99)))
    assert [tuple(r) for r in got.select("user_id", "product_id", "ts_ms", "late", F.unix_millis("ts")).collect()] == [
        ("u", None, 12, False, 12), ("u", None, 0, False, 99), ("u", None, 12, False, 12)]


@pytest.mark.parametrize("bad", ["{bad", "", "[1]", '{"ts_ms":"soon"}'])
def test_malformed_records(spark, bad):
    raw = messages.rows(spark, [bad, '{"user_id":"u","ts_ms":1}'])
    with pytest.raises(Exception, match="malformed record"):
        codec.decode(raw, schemas.PAGE_VIEW).select("user_id").collect()
    assert codec.decode(raw, schemas.PAGE_VIEW, "skip").count() == 1
    kept = codec.decode(raw, schemas.PAGE_VIEW, "quarantine")
    assert rows(kept, "malformed") == sorted([(bad,), (None,)], key=repr)


def test_purchase_numbers(spark):
    raw = messages.rows(spark, ['{"user_id":"u","product_id":"p","amount_usd":"9.50","ts_ms":7.9,"fraud_hint":true}'])
    got = codec.decode(raw, schemas.PURCHASE)
    assert rows(got, "amount_usd", "ts_ms", "fraud_hint") == [(9.5, 7, True)]


def test_encode_keeps_nulls(spark):
    df = spark.createDataFrame([("tumbling", 0, 10, 3, None)], schemas.WINDOW_RESULT)
    value = codec.encode(df).first()["value"]
    assert json.loads(value) == {"kind": "tumbling", "window_start_ms": 0, "window_end_ms": 10, "count": 3, "user_id": None}


def test_route(spark):
    good = '{"kind":"session","window_start_ms":1,"window_end_ms":2,"count":1,"user_id":"u"}'
    raw = messages.rows(spark, [good, good[:-3]], "results.windows.sessions").unionByName(messages.rows(spark, [good], "x"))
    assert rows(codec.route(raw, schemas.RESULT_TOPICS, schemas.WINDOW_RESULT), "type", "user_id") == [("session", "u")]


def test_relay_keeps_any_layout(spark):
    raw = (messages.rows(spark, ['{"a":1}', "[1,2]", "{oops"], "results.topk")
           .unionByName(messages.rows(spark, ['{"b":null}'], "results.fraud")).unionByName(messages.rows(spark, ["{}"], "x")))
    assert rows(codec.relay(raw, schemas.RESULT_TOPICS), "type", "payload") == [
        ("fraud", '{"b":null}'), ("topk", "[1,2]"), ("topk", '{"a":1}')]


@pytest.mark.parametrize("on_error", ["fail", "skip", "quarantine"])
def test_records_are_parsed_once_below_filters_and_joins(spark, on_error):
    decoded = codec.decode(spark.read.format("text").load("/root/testdata/sf0.001/events.parquet"), schemas.PURCHASE, on_error)
    other = spark.range(10).select(F.col("id").cast("string").alias("user_id"))
    joined = decoded.filter("amount_usd > 5 AND product_id <> 'x'").join(other, "user_id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
