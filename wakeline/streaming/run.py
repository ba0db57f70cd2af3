"""Start streaming queries on any of the supported sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from wakeline.operators.codec import encode

AVAILABLE_NOW = "available now"
EVERY = "10 seconds"
FILE_SINKS = ("parquet", "json", "orc", "csv")


def start(df: DataFrame, sink: str | Callable[[DataFrame, int], None], checkpoint: str, path: str | None = None,
          output_mode: str = "append", trigger: str = EVERY, name: str | None = None,
          **options: str) -> StreamingQuery:
    """Start ``df`` and return the running query.

    ``sink`` is a file format (exactly once; ``path`` is the folder), ``kafka`` (at least once;
    ``path`` is the topic, rows are sent as JSON text), ``memory`` (tests; needs ``name``),
    ``noop``, or a function of (micro-batch, batch id).

    ``checkpoint`` is a folder on shared storage: a restarted query resumes its offsets and state
    from it.  ``trigger`` is the interval between micro-batches, which is also how often progress
    is checkpointed, or ``AVAILABLE_NOW`` to work off what there is and stop.
    """
    if sink == "kafka":
        df, options = encode(df), {"topic": path, **options}
    writer = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).options(**options)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if trigger == AVAILABLE_NOW else writer.trigger(processingTime=trigger)
    if callable(sink):
        return writer.foreachBatch(sink).start()
    if sink in FILE_SINKS:
        return writer.format(sink).option("path", path).start()
    return writer.format(sink).start()


def finish(*queries: StreamingQuery) -> None:
    """Wait for queries started with ``AVAILABLE_NOW`` and raise what stopped them, if anything."""
    for query in queries:
        query.awaitTermination()
