"""Per-micro-batch work: bounded result tables and a side output for late rows.

Every function writes to a folder named after the batch id and reads the one before it, so a
batch that is run again after a failure overwrites its own output and changes nothing else.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from wakeline.functions.timecols import DEFAULT_DELAY, SECOND, floor_to, ms
from wakeline.operators.results import recent_n


def keep_recent(folder: str, order: Callable[[], list[Column]], n: int = 50,
                by: str = "type") -> Callable[[DataFrame, int], None]:
    """Maintain the ``n`` newest rows per type; version ``v=<batch id>`` of ``folder`` is current.

    With ``n=1`` it is the latest result per type.  A version holds at most ``n`` rows per type.
    """
    def work(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("_recv_ts", F.unix_millis(F.current_timestamp()))
        if batch_id > 0:
            before = batch.sparkSession.read.parquet(f"{folder}/v={batch_id - 1}").drop("position")
            rows = rows.unionByName(before)
        recent_n(rows, order(), n, by).coalesce(1).write.mode("overwrite").parquet(f"{folder}/v={batch_id}")

    return work


def split_late(on_time_path: str, late_path: str, marks_path: str, size: int = 10 * SECOND,
               delay: int = DEFAULT_DELAY) -> Callable[[DataFrame, int], None]:
    """Write rows whose tumbling window had closed before their batch to ``late_path``.

    The watermark in force is the largest event time of all earlier batches minus ``delay``; that
    one number is kept in ``marks_path`` per batch.
    """
    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = f"batch_id={batch_id}"
        before = None
        if batch_id > 0:
            before = spark.read.parquet(f"{marks_path}/batch_id={batch_id - 1}").first()["top_ms"]
        batch = batch.persist()
        mark = F.lit(None if before is None else before - delay).cast("bigint")
        late = F.coalesce(floor_to(ms(), size) + size <= mark, F.lit(False))
        batch.filter(~late).write.mode("overwrite").parquet(f"{on_time_path}/{folder}")
        batch.filter(late).write.mode("overwrite").parquet(f"{late_path}/{folder}")
        top = batch.agg(F.greatest(F.max(ms()), F.lit(before).cast("bigint")).alias("top_ms"))
        top.write.mode("overwrite").parquet(f"{marks_path}/{folder}")
        batch.unpersist()

    return work
