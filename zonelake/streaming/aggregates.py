"""Windowed aggregates, the same for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_totals(
    quotes: DataFrame,
    length: str = "1 minute",
    watermark: str | None = "2 minutes",
    slide: str | None = None,
    key: str = "symbol",
    time: str = "timestamp",
    price: str = "current_price",
    volume: str = "volume",
) -> DataFrame:
    """(key, window_start, window_end, avg_price, total_volume).  Rows without a time fall out.

    In ``append`` and ``update`` mode the watermark bounds the state and drops rows that come too late; in
    ``complete`` mode nothing is dropped.  Rows are combined per (key, window) before the shuffle, so a symbol with a
    third of all quotes is one row per window and task.
    """
    if quotes.isStreaming and watermark:
        quotes = quotes.withWatermark(time, watermark)
    spans = F.window(F.col(time), length, slide) if slide else F.window(F.col(time), length)
    totals = quotes.groupBy(key, spans.alias("_window")).agg(
        F.avg(price).alias("avg_price"), F.sum(volume).alias("total_volume")
    )
    return totals.select(
        key,
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        "avg_price",
        "total_volume",
    )


def window_growth(
    quotes: DataFrame, length: str = "1 minute", key: str = "symbol", time: str = "timestamp", volume: str = "volume"
) -> DataFrame:
    """(key, window_start, window_end, volume_growth): last minus first value of a counter that only grows by day."""
    first_last = quotes.groupBy(key, F.window(F.col(time), length).alias("_window")).agg(
        F.min_by(volume, time).alias("_first"), F.max_by(volume, time).alias("_last")
    )
    return first_last.select(
        key,
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        (F.col("_last") - F.col("_first")).alias("volume_growth"),
    )
