"""Event-time arithmetic on epoch milliseconds, and watermarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SECOND = 1_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR

DEFAULT_DELAY = 5 * SECOND


def ms(column: str | Column = "ts") -> Column:
    """Epoch milliseconds of a timestamp column."""
    return F.unix_millis(column)


def floor_to(millis: Column, size: int) -> Column:
    """Start of the epoch-aligned cell of ``size`` ms that holds ``millis`` (also before 1970)."""
    return millis - F.pmod(millis, F.lit(size).cast("bigint"))


def duration(millis: int) -> str:
    return f"{millis} milliseconds"


def bounds(window: str) -> list[Column]:
    """``window_start_ms`` and ``window_end_ms`` of a window struct column."""
    return [ms(F.col(f"{window}.start")).alias("window_start_ms"),
            ms(F.col(f"{window}.end")).alias("window_end_ms")]


def with_watermark(df: DataFrame, delay: int = DEFAULT_DELAY, column: str = "ts") -> DataFrame:
    """Bounded out-of-orderness: watermark = max event time seen - ``delay`` ms."""
    return df.withWatermark(column, duration(delay))
