"""Gap detection, classification, filling and streaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.catalog import MARKETS
from .sessions import gap_in_hours

def W():
    return Window.partitionBy("symbol").orderBy("time")



def minutes(a, b):
    return F.timestamp_diff("MICROSECOND", a, b) / 60e6


def detect_gaps(bars: DataFrame, market: str = "US500", threshold: float | None = None, imputable_up_to: int = 30) -> DataFrame:
    """(symbol, gap_start, gap_end, gap_minutes, market_hours, gap_type, reason); the threshold is exceeded strictly."""
    limit = MARKETS[market]["gap_minutes"] if threshold is None else threshold
    g = bars.select("symbol", F.lag("time").over(W()).alias("gap_start"), F.col("time").alias("gap_end"))
    g = g.withColumn("m", minutes(F.col("gap_start"), F.col("gap_end"))).where(F.col("m") > limit)
    g = g.select("symbol", "gap_start", "gap_end", F.floor("m").cast("long").alias("gap_minutes"), gap_in_hours(F.col("gap_start"), F.col("gap_end"), market).alias("market_hours"))
    kind = F.when(~F.col("market_hours"), "ignored").when(F.col("gap_minutes") <= imputable_up_to, "imputable").otherwise("not_imputable")
    reason = F.when(~F.col("market_hours"), "fuera_de_horario").when(F.col("gap_minutes") <= imputable_up_to, "gap_corto").otherwise("gap_largo")
    return g.select("*", kind.alias("gap_type"), reason.alias("reason"))


def gap_buckets(gaps: DataFrame) -> DataFrame:
    m = F.col("gap_minutes")
    bucket = F.when(m <= 15, "5-15").when(m <= 30, "15-30").when(m <= 60, "30-60").otherwise(">60")
    return gaps.groupBy("symbol", bucket.alias("bucket")).agg(F.count("*").alias("n"), F.sum("gap_minutes").alias("total_minutes"), F.sum(F.floor(m / 5)).cast("long").alias("bars_missing"))


def label_large_gaps(gaps: DataFrame, over: int = 60) -> DataFrame:
    return gaps.withColumn("status", F.when(F.col("gap_minutes") > over, "unresolved").otherwise("ok"))


def expected_slots(bars: DataFrame, step: str = "INTERVAL 1 HOUR") -> DataFrame:
    """Every slot of each symbol's days, from the first to the last day it has."""
    span = bars.groupBy("symbol").agg(F.min(F.to_date("time")).alias("a"), F.max(F.to_date("time")).alias("b"))
    day = span.select("symbol", F.explode(F.sequence("a", "b")).alias("d"))
    start = F.col("d").cast("timestamp_ntz")
    return day.select("symbol", F.explode(F.sequence(start, start + F.expr("INTERVAL 1 DAY") - F.expr(step), F.expr(step))).alias("time"))


def missing_slots(bars: DataFrame, step: str = "INTERVAL 1 HOUR") -> DataFrame:
    return expected_slots(bars, step).join(bars.select("symbol", "time"), ["symbol", "time"], "left_anti")


def daily_coverage(bars: DataFrame, expected: int) -> DataFrame:
    """(symbol, date, expected, actual, coverage, grade) over all days of a symbol's span; days without bars are 0."""
    actual = bars.groupBy("symbol", F.to_date("time").alias("date")).agg(F.count("*").alias("n"))
    span = bars.groupBy("symbol").agg(F.min(F.to_date("time")).alias("a"), F.max(F.to_date("time")).alias("b")).select("symbol", F.explode(F.sequence("a", "b")).alias("date"))
    cov = F.round(100.0 * F.coalesce("n", F.lit(0)) / expected, 6)
    grade = F.when(F.col("coverage") >= 95, "A").when(F.col("coverage") >= 90, "B").when(F.col("coverage") >= 80, "C").otherwise("D")
    return span.join(actual, ["symbol", "date"], "full_outer").select("symbol", "date", F.lit(expected).alias("expected"), F.coalesce("n", F.lit(0)).cast("long").alias("actual"), cov.alias("coverage")).withColumn("grade", grade)


def bridge_fill(bars: DataFrame, step_minutes: int = 5, max_minutes: int = 30, noise: float = 0.0, seed: int = 42, market: str | None = "US500", threshold: float | None = None) -> DataFrame:
    """Bars at the missing slots strictly inside imputable gaps, by a bridge between the bars at both ends.

    noise scales the normal term (0: linear; the usual value is 0.001); draws depend on (seed, symbol, time, column), so
    a rerun repeats them. Volumes are 0, spread the mean of both ends, high and low are widened to the envelope.
    market None: any gap of at most max_minutes is filled.
    """
    cols = ("open", "high", "low", "close")
    g = bars.select("symbol", "time", *cols, "spread", *[F.lag(c).over(W()).alias(f"p_{c}") for c in ("time", *cols, "spread")])
    gap = minutes(F.col("p_time"), F.col("time"))
    limit = threshold if threshold is not None else MARKETS[market]["gap_minutes"] if market else step_minutes
    g = g.where((gap > limit) & (F.floor(gap) <= max_minutes) & (gap_in_hours(F.col("p_time"), F.col("time"), market) if market else F.lit(True)))
    step = F.expr(f"INTERVAL {step_minutes} MINUTE")
    g = g.where(gap > step_minutes).withColumn("slots", F.filter(F.sequence(F.col("p_time") + step, F.col("time"), step), lambda s: s < F.col("time")))
    g = g.select("*", F.size("slots").alias("n"), F.posexplode("slots").alias("i", "slot"))
    a = (F.col("i") + 1) / (F.col("n") + 1)

    def value(c: str):
        u1 = F.abs(F.xxhash64("symbol", "slot", F.lit(c), F.lit(seed)) % 1_000_000_007) / 1_000_000_008.0
        u2 = F.abs(F.xxhash64("symbol", "slot", F.lit(c), F.lit(seed + 1)) % 1_000_000_007) / 1_000_000_008.0
        normal = F.sqrt(-2 * F.ln(1 - u1)) * F.cos(6.283185307179586 * u2)
        base = F.col(f"p_{c}") + a * (F.col(c) - F.col(f"p_{c}"))
        return base + normal * F.sqrt(a * (1 - a) * F.abs(F.col(c) - F.col(f"p_{c}")) * noise) if noise else base

    v = g.select("symbol", F.col("slot").alias("time"), *[value(c).alias(c) for c in cols], ((F.col("p_spread") + F.col("spread")) / 2).alias("spread"))
    env = {"high": F.greatest("open", "high", "low", "close"), "low": F.least("open", "high", "low", "close")}
    return v.withColumns(env).select("symbol", "time", *cols, F.lit(0).cast("long").alias("tick_volume"), F.lit(0).cast("long").alias("real_volume"), "spread", F.lit("M5_IMPUTADO_BROWNIAN").alias("data_origin"), F.lit(0.7).alias("quality_score"))


def random_walk_fill(bars: DataFrame, step_minutes: int = 5, max_minutes: int = 60, seed: int = 42, linear_up_to: int = 10) -> DataFrame:
    """Bars in gaps of at most `max_minutes`: up to `linear_up_to` slots linear with no volume, beyond it a random walk between
    the closes at both ends, high and low 0.1 % away, with a drawn volume. Draws depend on (seed, symbol, time)."""
    short = bridge_fill(bars, step_minutes, min(max_minutes, step_minutes * (linear_up_to + 1)), market=None).withColumns({"data_origin": F.lit("M5_IMPUTADO_INTERPOLADO"), "quality_score": F.lit(0.6)})
    g = bars.select("symbol", "time", "close", "spread", *[F.lag(c).over(W()).alias(f"p_{c}") for c in ("time", "close", "spread")])
    gap = minutes(F.col("p_time"), F.col("time"))
    g = g.where((gap > step_minutes * (linear_up_to + 1)) & (F.floor(gap) <= max_minutes))
    step = F.expr(f"INTERVAL {step_minutes} MINUTE")
    slots = F.filter(F.sequence(F.col("p_time") + step, F.col("time"), step), lambda s: s < F.col("time"))
    g = g.select("*", F.explode(slots).alias("slot")).where(F.size(slots) > linear_up_to)
    draw = lambda k: F.pmod(F.xxhash64("symbol", "slot", F.lit(seed + k)), F.lit(1_000_000_007)) / 1_000_000_008.0
    g = g.withColumn("z", F.sqrt(-2 * F.ln(1 - draw(0))) * F.cos(6.283185307179586 * draw(1)))
    one = Window.partitionBy("symbol", "p_time")  # a gap's own slots, bounded by max_minutes
    g = g.withColumns({"walk": F.sum("z").over(one.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)), "whole": F.sum("z").over(one)})
    price = F.col("p_close") + F.coalesce(F.try_divide(F.col("walk"), F.col("whole")), F.lit(0.0)) * (F.col("close") - F.col("p_close"))
    long = g.select("symbol", F.col("slot").alias("time"), price.alias("open"), F.greatest(price, price * 1.001).alias("high"), F.least(price, price * 0.999).alias("low"), price.alias("close"), (100 + F.floor(draw(2) * 900)).cast("long").alias("tick_volume"), F.lit(0).cast("long").alias("real_volume"), ((F.col("p_spread") + F.col("spread")) / 2).alias("spread"), F.lit("M5_IMPUTADO_BROWNIAN").alias("data_origin"), F.lit(0.7).alias("quality_score"))
    return short.select(*long.columns).unionByName(long)


def islands(df: DataFrame, flag, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Runs of consecutive rows where flag holds: (keys, streak_start, streak_end, length)."""
    by = Window.partitionBy(*keys).orderBy("time")
    t = df.select(*keys, "time", flag.alias("f")).withColumn("c", (F.col("f") != F.coalesce(F.lag("f").over(by), ~F.col("f"))).cast("int"))
    t = t.withColumn("run", F.sum("c").over(by.rowsBetween(Window.unboundedPreceding, 0))).where("f")
    return t.groupBy(*keys, "run").agg(F.min("time").alias("streak_start"), F.max("time").alias("streak_end"), F.count("*").alias("length")).drop("run")


def synthetic_streaks(bars: DataFrame, at_least: int = 3) -> DataFrame:
    return islands(bars, F.col("data_origin").contains("IMPUTADO")).where(F.col("length") >= at_least)


def imputation_quality(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows added and relative changes of mean and deviation of close and mean of volume: two one-row aggregates."""
    def one(df: DataFrame, p: str) -> DataFrame:
        return df.agg(F.count("*").alias(f"{p}n"), F.avg("close").alias(f"{p}mean"), F.stddev_samp("close").alias(f"{p}std"), F.avg("tick_volume").alias(f"{p}vol"))

    x = one(before, "b_").join(F.broadcast(one(after, "a_")), F.lit(True))
    diff = lambda k: (100 * F.try_divide(F.col(f"a_{k}") - F.col(f"b_{k}"), F.col(f"b_{k}"))).alias(f"{k}_diff_pct")
    return x.select((F.col("a_n") - F.col("b_n")).alias("rows_added"), diff("mean"), diff("std"), diff("vol"))


def neighbour_interval(bars: DataFrame) -> DataFrame:
    """mean_interval: mean of up to five intervals before and after each bar, in minutes."""
    d = bars.withColumn("__d", minutes(F.col("time"), F.lead("time").over(W())))
    return d.withColumn("mean_interval", F.avg("__d").over(W().rowsBetween(-5, 4))).drop("__d")
