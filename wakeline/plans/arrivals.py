"""The stored events in an order of arrival, some of them late, for the registered lateness queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wakeline.functions.timecols import HOUR
from wakeline.sources.activity import activity

# deterministic lateness: one event in LATE_EVERY is up to LATE_MAX ms behind its arrival
LATE_EVERY = 5
LATE_MAX = 6 * HOUR
LATE_STRIDE = 7919
PARTITIONS = 4


def arrival_log(spark: SparkSession, sf_dir: str, batch_rows: int = 50) -> DataFrame:
    """Events in arrival order (``batch``, ``arrival_ms``), some with an earlier event time."""
    shift = F.when(F.col("event_id") % LATE_EVERY == 0, F.col("event_id") * LATE_STRIDE % LATE_MAX).otherwise(F.lit(0))
    late_flag = F.col("event_id") % LATE_EVERY == 0
    number = F.substring_index("product_id", "_", -1).cast("int")
    return (activity(spark, sf_dir)
            .withColumn("arrival_ms", F.col("ts_ms"))
            .withColumn("ts_ms", F.col("ts_ms") - shift)
            .withColumn("ts", F.timestamp_millis("ts_ms"))
            .withColumn("late_flag", late_flag)
            .withColumn("partition", F.pmod(number, F.lit(PARTITIONS)))
            .withColumn("batch", F.expr(f"event_id div {batch_rows}")))
