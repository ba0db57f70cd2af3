"""Grow the stored events, give one user a third of them, and time the operators on both.

    python scale_check.py [copies] [operator ...]

The grown table is derived by Spark from ``events``: every copy has its own users and is shifted
by a few seconds.  In the skewed variant a third of all rows belongs to one user.  Operators run
with their default (narrow) parameters and results are counted, not collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from wakeline.functions.timecols import HOUR
from wakeline.operators import joins, lateness, patterns, results, topk, windows
from wakeline.session import get_session, shared_dir
from wakeline.plans.arrivals import PARTITIONS, arrival_log
from wakeline.sources import activity as src

BASE = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")


def grow(spark: SparkSession, copies: int, skewed: bool, folder: str) -> str:
    events = spark.read.parquet(f"{BASE}/events.parquet")
    rows = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    user = F.col("user_id") + F.col("copy") * 1_000_000
    if skewed:
        user = F.when(F.pmod(F.xxhash64("event_id", "copy"), F.lit(3)) == 0, F.lit(7)).otherwise(user)
    shift = F.expr("make_dt_interval(0, 0, 0, copy * 13 % 2592)")
    (rows.select((F.col("event_id") * copies + F.col("copy")).alias("event_id"), (F.col("ts") + shift).alias("ts"),
                 user.cast("bigint").alias("user_id"), "event_type", "value", "props")
     .write.parquet(f"{folder}/events.parquet"))
    return folder


def operators(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    views, bought = src.page_views(spark, folder), src.purchases(spark, folder)
    log = arrival_log(spark, folder, batch_rows=1000)
    sessions = windows.session_counts(views)
    return {
        "tumbling_by_product": windows.counts_by_product(views, HOUR),
        "sliding_count": windows.sliding_counts(views),
        "session_count": sessions,
        "session_metrics": windows.session_metrics(views),
        "topk_products": topk.topk_products(views, 10, HOUR),
        "share_of_max": topk.share_of_max(windows.counts_by_product(views, HOUR)),
        "interval_join": joins.interval_join(views, bought),
        "interval_join_salted": joins.interval_join(views, bought, salts=8),
        "window_join": joins.window_join(views, bought, 60_000),
        "conversion": joins.conversion(views, bought),
        "funnel": joins.funnel(views, bought),
        "rapid_purchases": patterns.rapid_purchases(bought),
        "threshold_anomaly": patterns.threshold_anomaly(bought, 150),
        "late_counts": lateness.late_counts(log, HOUR),
        "late_dropped_windows": lateness.late_dropped_windows(log, HOUR, HOUR),
        "min_watermark": lateness.min_watermark(log, list(range(PARTITIONS)), HOUR),
        "max_concurrent_sessions": results.max_concurrent(sessions),
    }


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 50
    wanted = set(sys.argv[2:])
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session("scale_check", f"local[{cpus}]", spark__sql__shuffle__partitions="32",
                        spark__driver__memory="16g", spark__ui__enabled="false",
                        # keep the joins in the form they take on tables too large to broadcast
                        spark__sql__autoBroadcastJoinThreshold="1m",
                        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4m",
                        spark__sql__adaptive__advisoryPartitionSizeInBytes="4m")
    spark.sparkContext.setLogLevel("ERROR")
    for skewed in (False, True):
        folder = grow(spark, copies, skewed, shared_dir(spark, "scale"))
        for name, df in operators(spark, folder).items():
            if wanted and name not in wanted:
                continue
            began = time.time()
            # the hash keeps every column alive
            n = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.xxhash64(*df.columns))).first()["n"]
            print(json.dumps({"skewed": skewed, "operator": name, "rows_in": copies * 100_000, "rows_out": n,
                              "sec": round(time.time() - began, 2)}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
