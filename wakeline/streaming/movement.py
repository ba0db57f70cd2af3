"""Rank movement on a stream: each board against the board before it, as boards close.

Boards are compared inside chunks of time.  Only the first board of a chunk and what a chunk ends with
go through the one key that knows what came before, so that key sees two rows per chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType, TimestampType

from wakeline.functions.timecols import HOUR, SECOND, bounds, floor_to
from wakeline.operators.topk import BUCKETS, board_stream
from wakeline.streaming.clock import moment

_PRODUCTS = ArrayType(StringType())
_LAST = StructType([StructField("products", _PRODUCTS)])
_BOARD = StructType([
    StructField("at", TimestampType()), StructField("route", LongType()), StructField("chunk", LongType()), StructField("over", BooleanType()),
    StructField("window_start_ms", LongType()), StructField("products", _PRODUCTS), StructField("before", _PRODUCTS)])


class InsideChunk(StatefulProcessor):
    """The boards that close in one chunk, each with the one before it; the key is the end of the chunk.

    State is the last board, and goes when the watermark reaches the end of the chunk.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", _LAST)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = self.last.get()[0] if self.last.exists() else None
        for row in sorted(rows, key=lambda r: r.end_ms):
            yield Row(at=moment(row.end_ms), route=None if last is None else key[0], chunk=key[0], over=False,
                      window_start_ms=row.window_start_ms, products=row.products, before=last)
            last = row.products
        self.last.update((last,))
        self.handle.registerTimer(key[0])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.last.exists():
            yield Row(at=moment(key[0]), route=None, chunk=key[0], over=True, window_start_ms=None, products=self.last.get()[0], before=None)
            self.last.clear()


class BetweenChunks(StatefulProcessor):
    """Gives the first board of each chunk the last one of the chunk before; other boards pass.

    State is one board.  Chunks come in order: one closes in the same micro-batch as the first board of the next, or before.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", _LAST)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if key[0] is not None:
            yield from rows
            return
        last = self.last.get()[0] if self.last.exists() else None
        for row in sorted(rows, key=lambda r: (r.chunk, r.over)):
            if row.over:
                last = row.products
            else:
                yield Row(**{**row.asDict(), "before": last})
        if last is not None:
            self.last.update((last,))


def rank_movement_stream(views: DataFrame, k: int = 10, size: int = 10 * SECOND, slide: int | None = None, chunk: int = HOUR,
                         buckets: int = BUCKETS) -> DataFrame:
    """(window_start_ms, rank, product_id, prev_rank, movement) of every board as it closes; equals ``topk.rank_movement``
    over ``topk.topk_products``.  Windows without events have no board and are skipped.

    ``views`` has a watermark on ``ts``; needs the RocksDB state store.
    """
    boards = board_stream(views, k, size, slide, buckets).select(
        F.window_time("w").alias("ts"), *bounds("w"), F.col("best.product_id").alias("products"))
    # boards belong to the chunk in which their window ends, so that none comes after its chunk is over
    chunk_end = floor_to(F.col("window_end_ms") - 1, chunk) + chunk
    inside = boards.select("ts", "window_start_ms", F.col("window_end_ms").alias("end_ms"), "products", chunk_end.alias("chunk")).groupBy(
        "chunk").transformWithState(InsideChunk(), outputStructType=_BOARD, outputMode="append", timeMode="eventTime", eventTimeColumnName="at")
    placed = inside.groupBy("route").transformWithState(
        BetweenChunks(), outputStructType=_BOARD, outputMode="append", timeMode="eventTime", eventTimeColumnName="at")
    before = F.nullif(F.array_position("before", F.col("product_id")), F.lit(0)).cast("int")
    ranked = placed.select("window_start_ms", "before", F.posexplode("products").alias("pos", "product_id"))
    return ranked.select("window_start_ms", (F.col("pos") + 1).alias("rank"), "product_id", before.alias("prev_rank")).withColumn(
        "movement", F.col("prev_rank") - F.col("rank"))
