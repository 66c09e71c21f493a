"""Bringing captured sources to five-minute bars, conforming and checking them before they are written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.catalog import TIMEFRAMES
from ..sources.tables import BAR_DEFAULTS
from .resample import priority

PRICES = ("open", "high", "low", "close")
REQUIRED = ("time", *PRICES)
# Columns by the width they are stored in.
SINGLE = (*PRICES, "spread")
SINGLE_PARTS = ("ema_", "sma_", "rsi_", "bb_", "atr_", "volatility_", "stoch_", "macd")
WIDTHS = {"tick_volume": "int", "real_volume": "int"} | dict.fromkeys("is_first_hour is_last_hour is_lunch_time is_morning is_afternoon".split(), "smallint") | dict.fromkeys("hour minute day_of_week day_of_month month quarter".split(), "tinyint")


def epoch_times(rates: DataFrame, col: str = "time") -> DataFrame:
    """Seconds since 1970 (UTC) as timestamps."""
    return rates.withColumn(col, F.timestamp_seconds(F.col(col)).cast("timestamp_ntz"))


def ticks_from(ticks: DataFrame, start: str, n: int, end: str | None = None) -> DataFrame:
    """The first n ticks from a time on, those after `end` left out."""
    first = ticks.where(F.col("time") >= F.lit(start).cast("timestamp_ntz")).orderBy("time", "seq").limit(n)
    return first.where(F.col("time") <= F.lit(end).cast("timestamp_ntz")) if end else first


def last_ticks_to_bars(ticks: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Bars of (time, last, volume, spread) ticks: prices of the last trade."""
    at = F.struct("time", "seq")
    b = ticks.groupBy("symbol", F.window("time", width).alias("w")).agg(F.min_by("last", at).alias("open"), F.max("last").alias("high"), F.min("last").alias("low"), F.max_by("last", at).alias("close"), F.count("*").alias("tick_volume"), F.sum("volume").alias("real_volume"))
    return b.select("symbol", F.col("w.start").alias("time"), *PRICES, "tick_volume", "real_volume")


def all_to_m5(bars: DataFrame) -> DataFrame:
    """Bars of several timeframes as five-minute bars: one aggregate that keeps the timeframe, M5 as it is, coarser bars
    relabelled (one bar a source bar), then the best source of each time."""
    tf = F.col("source_timeframe")
    b = bars.groupBy("symbol", F.window("time", "5 minutes").alias("w"), "source_timeframe").agg(
        F.min_by("open", "time").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "time").alias("close"), F.sum("tick_volume").alias("tick_volume"), F.sum("real_volume").alias("real_volume"),
    )
    origin = F.when(tf == "M5", "M5_NATIVO").otherwise(F.concat(F.lit("M5_AGREGADO_"), F.upper(tf)))
    b = b.select("symbol", F.col("w.start").alias("time"), *PRICES, "tick_volume", "real_volume", "source_timeframe", origin.alias("data_origin"))
    best = F.struct((-priority()).alias("p"), "source_timeframe").alias("o")
    w = Window.partitionBy("symbol", "time").orderBy("o")
    return b.withColumn("o", best).withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("o", "rn").withColumn("quality_score", priority())


def fallback(primary: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of the first table, and of each later one those whose (symbol, time) no earlier one has. One exchange: the
    source's rank decides, so nothing is joined or counted."""
    ranked = [df.withColumn("__rank", F.lit(i)) for i, df in enumerate((primary, *others))]
    t = ranked[0]
    for df in ranked[1:]:
        t = t.unionByName(df, allowMissingColumns=True)
    best = F.min("__rank").over(Window.partitionBy("symbol", "time"))
    return t.withColumn("__best", best).where("__rank = __best").drop("__rank", "__best")


def recapture(gaps: DataFrame, bars: DataFrame, second: DataFrame, over: int = 60) -> DataFrame:
    """Bars of a second source strictly inside gaps of over so many minutes; gaps are few beside bars."""
    g = gaps.where(F.col("gap_minutes") > over).select(F.col("symbol").alias("g_symbol"), "gap_start", "gap_end")
    return second.join(g, (F.col("symbol") == F.col("g_symbol")) & (F.col("time") > F.col("gap_start")) & (F.col("time") < F.col("gap_end"))).drop("g_symbol", "gap_start", "gap_end")


def conform_types(df: DataFrame) -> DataFrame:
    """The first of repeated column names, `return` renamed to `returns`, text in numeric columns read as numbers."""
    seen: set[str] = set()
    names = ["returns" if n == "return" else n for n in df.columns]
    unique = df.toDF(*[f"c{i}" for i in range(len(names))])
    out: list[Column] = []
    for i, n in enumerate(names):
        if n in seen:
            continue
        seen.add(n)
        kind = BAR_DEFAULTS.get(n, (None,))[0]
        c = F.col(f"c{i}")
        out.append((c.try_cast(kind) if kind and isinstance(unique.schema[i].dataType, T.StringType) and kind != "string" else c).alias(n))
    return unique.select(*out)


def save_check(df: DataFrame) -> DataFrame:
    """One row: rows, nulls in required columns, missing required columns, text columns, negative prices and volumes."""
    have = [c for c in REQUIRED if c in df.columns]
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    negative = [c for c in (*PRICES, "tick_volume", "real_volume") if c in df.columns]
    least = F.least(*[F.col(c).cast("double") for c in negative]) if len(negative) > 1 else F.lit(0.0)
    return df.agg(F.count("*").alias("n"), sum((F.count_if(F.col(c).isNull()) for c in have), F.lit(0)).cast("long").alias("nulls"), F.lit(len(REQUIRED) - len(have)).alias("missing_columns"), F.lit(len(text)).alias("text_columns"), F.count_if(least < 0).alias("negatives"))


def downcast(df: DataFrame) -> DataFrame:
    """Narrower types by column name; what does not fit a type is left as it is by the reader's choice of columns."""
    own = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType) and (f.name in SINGLE or any(p in f.name for p in SINGLE_PARTS)):
            own[f.name] = F.col(f.name).cast("float")
        elif isinstance(f.dataType, T.LongType) and f.name in WIDTHS:
            own[f.name] = F.col(f.name).cast(WIDTHS[f.name])
    return df.withColumns(own) if own else df


def feature_columns(df: DataFrame, base: tuple[str, ...] = tuple(BAR_DEFAULTS)) -> list[str]:
    return [c for c in df.columns if c not in (*base, "symbol", "time", "data_origin")]


def standard_time(df: DataFrame, zone: str = "UTC", text: bool = False) -> DataFrame:
    """Local times of a zone as UTC; as text `yyyy-MM-dd HH:mm:ss+0000` if asked for."""
    t = F.convert_timezone(F.lit(zone), F.lit("UTC"), F.col("time").cast("timestamp_ntz"))
    return df.withColumn("time", F.concat(F.date_format(t, "yyyy-MM-dd HH:mm:ss"), F.lit("+0000")) if text else t)


def simple_migration(df: DataFrame) -> DataFrame:
    """Every row as a native five-minute bar."""
    return df.withColumns({"data_origin": F.lit("M5_NATIVO"), "quality_score": F.lit(1.0), "source_timeframe": F.lit("M5"), "capture_method": F.lit("native")})


def file_report(spark, path: str) -> DataFrame:
    """(file, n, has_required, time_is_timestamp, first_time, last_time) of every file below a folder, read in one pass."""
    df = spark.read.parquet(path)
    ok = all(c in df.columns for c in REQUIRED)
    stamp = "time" in df.columns and isinstance(df.schema["time"].dataType, (T.TimestampType, T.TimestampNTZType))
    when = [F.min("time").alias("first_time"), F.max("time").alias("last_time")] if "time" in df.columns else []
    return df.groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"), F.lit(ok).alias("has_required"), F.lit(stamp).alias("time_is_timestamp"), *when)


def timeframe_minutes(col: str = "source_timeframe") -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for k, v in TIMEFRAMES.items() for x in (k, v[0])]), F.col(col))
