"""The stored ``events`` table as page views and purchases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def activity(spark: SparkSession, sf_dir: str, streaming: bool = False,
             files_per_batch: int | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """All events: ``event_id, user_id, event_type, product_id, amount_usd, ts_ms, ts``.

    Expects a UTC session: the stored timestamps carry no zone.  As a stream, what is there at the
    start is one micro-batch; limit ``files_per_batch`` only if the files follow each other in
    time, because the watermark of early files drops what later files hold of earlier times.
    ``start`` (inclusive) and ``end`` (exclusive), dates or times in text, limit what is read: they
    filter the stored column, so the scan skips row groups outside the range.
    """
    path = f"{sf_dir}/events.parquet"
    # the declared schema saves a pass over the file footers
    if streaming:
        # a file stream takes a folder or a pattern; this pattern fits the table only, be it one file or a folder
        reader = spark.readStream.schema(EVENTS)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
        events = reader.parquet(f"{sf_dir}/[e]vents.parquet")
    else:
        events = spark.read.schema(EVENTS).parquet(path)
    if start is not None:
        events = events.filter(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        events = events.filter(F.col("ts") < F.lit(end).cast("timestamp_ntz"))
    ts_ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return events.select(
        "event_id", F.col("user_id").cast("string").alias("user_id"), "event_type",
        F.concat(F.lit("product_"), F.get_json_object("props", "$.k")).alias("product_id"),
        F.col("value").alias("amount_usd"), ts_ms.alias("ts_ms"), F.timestamp_millis(ts_ms).alias("ts"))


def page_views(spark: SparkSession, sf_dir: str, streaming: bool = False, **limits) -> DataFrame:
    return activity(spark, sf_dir, streaming, **limits).filter(F.col("event_type") == "view").drop("event_type", "amount_usd")


def purchases(spark: SparkSession, sf_dir: str, streaming: bool = False, **limits) -> DataFrame:
    return activity(spark, sf_dir, streaming, **limits).filter(F.col("event_type") == "purchase").drop("event_type")
