"""Results that are fired when their window closes and again for every later change.

An aggregation in update mode writes its changed rows into a table with one version per micro-batch.
The watermark of the aggregation is the delay plus the lateness that windows are kept for; a window
closes when the delay alone has passed, which is told by the largest event time of the batches before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wakeline.functions.timecols import DEFAULT_DELAY, SECOND, bounds, duration, ms

#: Largest event time in a row of an aggregation for ``upsert``.
TOP = "top_ms"


def refiring_counts(df: DataFrame, size: int = 10 * SECOND, keys: tuple[str, ...] = ()) -> DataFrame:
    """Tumbling counts with what ``upsert`` needs; the watermark of ``df`` is delay plus lateness."""
    return (df.groupBy(F.window("ts", duration(size)).alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias("count"), F.max(ms()).alias(TOP))
            .select(*bounds("w"), *keys, "count", TOP))


def upsert(folder: str, delay: int = DEFAULT_DELAY) -> Callable[[DataFrame, int], None]:
    """A sink for an aggregation in update mode: the rows of a micro-batch become version ``v=<batch id>``.

    A version holds the changed rows only, each with ``closed``, whether its window had closed before the batch.  It
    is written over as a whole, so a batch that runs again after a failure leaves the table as it was.
    """
    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = spark.read.parquet(f"{folder}/tops/v={batch_id - 1}").first()[TOP] if batch_id > 0 else None
        batch = batch.persist()
        closed = F.lit(False) if before is None else F.col("window_end_ms") <= before - delay
        batch.drop(TOP).withColumn("closed", closed).write.mode("overwrite").parquet(f"{folder}/rows/v={batch_id}")
        batch.agg(F.greatest(F.max(TOP), F.lit(before).cast("bigint")).alias(TOP)).write.mode("overwrite").parquet(f"{folder}/tops/v={batch_id}")
        batch.unpersist()

    return work


def _known(spark: SparkSession, folder: str, name: str, until: int | None) -> DataFrame:
    rows = spark.read.option("basePath", f"{folder}/{name}").parquet(f"{folder}/{name}")
    return rows if until is None else rows.filter(F.col("v") <= until)


def firings(spark: SparkSession, folder: str, keys: tuple[str, ...] = (), delay: int = DEFAULT_DELAY, until: int | None = None) -> DataFrame:
    """All results fired up to version ``until`` (default: all): the keys, the values, and ``firing`` from 1.

    A window first fires when it closes, with what it held then, and again with each later version.  A
    window whose first row came after it had closed fires with that version.  Windows that have not
    closed are not shown.
    """
    names = ("window_start_ms", "window_end_ms", *keys)
    rows = _known(spark, folder, "rows", until)
    top = _known(spark, folder, "tops", until).agg(F.max(TOP)).first()[0]  # one number
    rows = rows.filter(F.col("window_end_ms") <= (-1 if top is None else top - delay))
    versions = Window.partitionBy(*names).orderBy("v")
    # of the versions before closing only the last one is ever fired
    fired = rows.withColumn("next_closed", F.lead("closed").over(versions)).filter("closed OR next_closed IS NULL OR next_closed")
    return fired.withColumn("firing", F.row_number().over(versions)).drop("next_closed", "closed", "v")


def current(spark: SparkSession, folder: str, keys: tuple[str, ...] = (), delay: int = DEFAULT_DELAY, until: int | None = None) -> DataFrame:
    """The last result fired for each closed window."""
    names = ("window_start_ms", "window_end_ms", *keys)
    shown = firings(spark, folder, keys, delay, until)
    values = [c for c in shown.columns if c not in names and c != "firing"]
    return (shown.groupBy(*names).agg(F.max_by(F.struct(*values), "firing").alias("r"), F.max("firing").alias("firings"))
            .select(*names, "r.*", "firings"))
