"""Counts over the whole run of a streaming query, however many micro-batches it has."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "run string, batch bigint, input_rows bigint, dropped_rows bigint"


class ProgressTable(StreamingQueryListener):
    """Writes every progress report of every query of the session into ``folder``, one small file keyed by (run,
    batch); a report that comes twice writes over itself.  Spark itself holds only the last hundred."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        dropped = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        row = [(str(p.runId), p.batchId, p.numInputRows, dropped)]
        self.spark.createDataFrame(row, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/{p.runId}/{p.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def watch(spark: SparkSession, folder: str) -> ProgressTable:
    """Keep progress from now on; end with ``spark.streams.removeListener``."""
    listener = ProgressTable(spark, folder)
    spark.streams.addListener(listener)
    return listener


def reports(spark: SparkSession, folder: str) -> DataFrame:
    """One row per run and micro-batch.  Reports come a moment after their batch."""
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(folder)


def dropped_by_watermark(spark: SparkSession, folder: str) -> DataFrame:
    """(run, batches, dropped_rows): rows that came too late for their state, per run."""
    return reports(spark, folder).groupBy("run").agg(F.count(F.lit(1)).alias("batches"), F.sum("dropped_rows").alias("dropped_rows"))
