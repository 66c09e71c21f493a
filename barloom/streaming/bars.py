"""Ticks to bars as a stream: event-time windows with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_bars(ticks: DataFrame, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """ticks: a streaming (symbol, time timestamp, price, volume, seq); append mode emits a bar once it can't change."""
    at = F.struct("time", "seq")
    w = ticks.withWatermark("time", late).groupBy(F.window("time", width).alias("w"), "symbol").agg(F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"), F.count("*").alias("tick_volume"), F.sum("volume").alias("real_volume"))
    return w.select("symbol", F.col("w.start").alias("time"), "open", "high", "low", "close", "tick_volume", "real_volume")
