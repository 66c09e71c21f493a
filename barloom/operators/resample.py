"""Ticks and bars into bars; prioritising sources; deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.catalog import PRIORITY

ROUND = 6


def ticks_of_events(events: DataFrame) -> DataFrame:
    return events.select(F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp_ntz").alias("time"), F.col("value").alias("price"), F.lit(1).cast("long").alias("volume"), F.col("event_id").alias("seq"))


def daily_ticks_of_lineitem(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(F.lit("LI").alias("symbol"), F.col("l_shipdate").cast("timestamp_ntz").alias("time"), F.col("l_extendedprice").alias("price"), F.col("l_quantity").cast("long").alias("volume"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))


def mid_price(ticks: DataFrame) -> DataFrame:
    """price = (bid + ask) / 2 where there is none; spread = ask - bid."""
    return ticks.withColumns({"price": (F.col("bid") + F.col("ask")) / 2, "spread": F.col("ask") - F.col("bid")})


def ticks_to_bars(ticks: DataFrame, width: str = "5 minutes") -> DataFrame:
    """One partial-aggregated groupBy; empty bins do not appear. seq breaks ties of time."""
    at = F.struct("time", "seq")
    spread = F.avg("spread") if "spread" in ticks.columns else F.lit(0.0)
    binned = ticks.groupBy("symbol", F.window("time", width).alias("w")).agg(
        F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"),
        F.count("*").alias("tick_volume"), F.sum("volume").alias("real_volume"), spread.alias("spread"),
    )
    return binned.select("symbol", F.col("w.start").alias("time"), "open", "high", "low", "close", "tick_volume", "real_volume", "spread", F.lit("M5_AGREGADO_TICKS").alias("data_origin"))


def resample_bars(bars: DataFrame, width: str = "5 minutes", origin: Column | str = "M5_AGREGADO_M1") -> DataFrame:
    b = bars.groupBy("symbol", F.window("time", width).alias("w")).agg(
        F.min_by("open", "time").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "time").alias("close"),
        F.sum("tick_volume").alias("tick_volume"), F.sum("real_volume").alias("real_volume"), F.avg("spread").alias("spread"),
    )
    return b.select("symbol", F.col("w.start").alias("time"), "open", "high", "low", "close", "tick_volume", "real_volume", "spread", (F.lit(origin) if isinstance(origin, str) else origin).alias("data_origin"))


def priority(source: Column | str = "source_timeframe") -> Column:
    c = F.col(source) if isinstance(source, str) else source
    out = F.lit(0.5)
    for name, value in PRIORITY.items():
        out = F.when(c == name, F.lit(value)).otherwise(out)
    return out


def prioritize(bars: DataFrame, tie: tuple[str, ...] = ("source_timeframe",)) -> DataFrame:
    """The best source of each (symbol, time); its priority is the quality score."""
    w = Window.partitionBy("symbol", "time").orderBy(F.desc("quality_score"), *tie)
    return bars.withColumn("quality_score", priority()).withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def dedupe(df: DataFrame, keep: str = "first", keys: tuple[str, ...] = ("symbol", "time"), order: str = "seq") -> DataFrame:
    """keep first or last by the ingest order."""
    w = Window.partitionBy(*keys).orderBy(F.asc(order) if keep == "first" else F.desc(order))
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def duplicates_report(df: DataFrame, keys: tuple[str, ...] = ("symbol", "time")) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def union_sources(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
