"""Quality state as aggregates: trackers, analyses, validators, scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.catalog import BARS_PER_YEAR
from .clean import correlation
from .gaps import islands
from .lineage import category_of
from .sessions import checklist_hours, local, minutes_since_previous

def W():
    return Window.partitionBy("symbol").orderBy("time")



def r(c: Column, n: int = 6) -> Column:
    return F.round(c, n)


def track(bars: DataFrame) -> DataFrame:
    """Per symbol, year and month: totals by kind of origin, mean score."""
    cat = category_of()
    native = F.count_if(F.col("data_origin") == "M5_NATIVO")
    agg_m1 = F.count_if(F.col("data_origin") == "M5_AGREGADO_M1")
    imputed = F.count_if(cat == "imputed")
    return bars.groupBy("symbol", F.year("time").alias("year"), F.month("time").alias("month")).agg(F.count("*").alias("total"), native.alias("native_m5"), agg_m1.alias("aggregated_m1"), imputed.alias("imputed"), (F.count("*") - native - agg_m1 - imputed).alias("other"), r(F.avg("quality_score")).alias("avg_score"), F.count_distinct("data_origin").alias("origins"))


def worst_records(bars: DataFrame, k: int = 100) -> DataFrame:
    """The k rows of least score (a top-k report)."""
    return bars.orderBy("quality_score", "time", "symbol").limit(k)


def completeness_heatmap(bars: DataFrame, expected_per_hour: int) -> DataFrame:
    day = bars.select(F.to_date("time").alias("date")).distinct()
    grid = day.select("date", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    got = bars.groupBy(F.to_date("time").alias("date"), F.hour("time").alias("hour")).agg(F.count("*").alias("n"), F.max_by("data_origin", "quality_score").alias("primary_source"))
    return grid.join(got, ["date", "hour"], "left").select("date", "hour", F.lit(expected_per_hour).alias("expected"), F.coalesce("n", F.lit(0)).cast("long").alias("captured"), r(100.0 * F.coalesce("n", F.lit(0)) / expected_per_hour).alias("pct"))


def hourly_analysis(bars: DataFrame) -> DataFrame:
    h = F.hour("time")
    return bars.groupBy(h.alias("hour")).agg(F.count("*").alias("n"), r(F.avg("tick_volume")).alias("avg_volume")).withColumn("session", F.when(F.col("hour").isin(9, 10), "opening").when(F.col("hour").isin(15, 16), "closing").when(F.col("hour").isin(12, 13), "lunch").otherwise("other"))


def pct_change(c: str, *extra: str) -> Column:
    p = F.lag(c).over(Window.partitionBy("symbol", *extra).orderBy("time"))
    return F.try_divide(F.col(c) - p, p)


def period_stats(bars: DataFrame, period: str = "year") -> DataFrame:
    key = F.year("time").alias("year") if period == "year" else F.date_format("time", "yyyy-MM").alias("month")
    name = "year" if period == "year" else "month"
    t = bars.withColumn(name, key).withColumn("__chg", F.try_divide(F.col("close") - (p := F.lag("close").over(Window.partitionBy("symbol", name).orderBy("time"))), p))
    return t.groupBy("symbol", name).agg(
        F.count("*").alias("n"), F.count_distinct(F.to_date("time")).alias("days"), r(F.max("high")).alias("high"), r(F.min("low")).alias("low"), r(F.avg("close")).alias("close_mean"), r(F.stddev_samp("close")).alias("close_std"),
        F.sum("tick_volume").alias("volume"), r(F.stddev_samp("__chg"), 4).alias("volatility"), r(F.stddev_samp("close") / F.avg("close")).alias("cv"),
    )


def volatility_report(bars: DataFrame, big: float = 0.02) -> DataFrame:
    t = bars.withColumn("r", pct_change("close"))
    return t.groupBy("symbol").agg(r(F.stddev_samp("r"), 4).alias("std"), r(F.stddev_samp("r") * BARS_PER_YEAR**0.5, 3).alias("annualized"), r(F.max("r"), 4).alias("best"), r(F.min("r"), 4).alias("worst"), F.count_if(F.abs("r") > big).alias("n_big"))


def volume_report(bars: DataFrame) -> DataFrame:
    daily = bars.groupBy("symbol", F.to_date("time").alias("date")).agg(F.sum("tick_volume").alias("v"))
    q = daily.groupBy("symbol").agg(F.percentile("v", 0.9).alias("hi"), F.percentile("v", 0.1).alias("lo"))
    return daily.join(q, "symbol").groupBy("symbol").agg(F.sum("v").alias("total"), r(F.avg("v")).alias("daily_mean"), F.count_if(F.col("v") > F.col("hi")).alias("high_days"), F.count_if(F.col("v") < F.col("lo")).alias("low_days"))


def temporal_patterns(bars: DataFrame) -> DataFrame:
    t = bars.withColumn("hour", F.hour("time"))
    t = t.withColumn("r", pct_change("close", "hour"))
    return t.groupBy("symbol", "hour").agg(F.count("*").alias("n"), r(F.avg("tick_volume")).alias("avg_volume"), r(F.stddev_samp("r"), 4).alias("volatility"))


# Validators: one row a symbol of counts and verdicts.


def ohlc_integrity(bars: DataFrame) -> DataFrame:
    o, h, low, c = (F.col(x) for x in ("open", "high", "low", "close"))
    bad = (h < low) | (h < F.greatest(o, c)) | (low > F.least(o, c))
    t = bars.withColumn("__chg", pct_change("close"))
    return t.groupBy("symbol").agg(F.count("*").alias("n"), F.count_if(bad).alias("order_violations"), F.count_if(F.least(o, h, low, c) <= 0).alias("non_positive"), F.count_if(F.abs("__chg") > 0.2).alias("large_moves"), (F.count_if(bad) == 0).alias("passed"))


def volume_integrity(bars: DataFrame, z: float = 5.0, least: int = 100) -> DataFrame:
    """Outliers are counted where there are more than `least` rows; spread: its statistics and negative values."""
    m = Window.partitionBy("symbol")
    t = bars.withColumn("__z", F.try_divide(F.col("tick_volume") - F.avg("tick_volume").over(m), F.stddev_pop("tick_volume").over(m)))
    outliers = F.when(F.count("*") > least, F.count_if(F.abs("__z") > z)).otherwise(0)
    return t.groupBy("symbol").agg(
        F.count_if(F.col("tick_volume") < 0).alias("negatives"), F.count_if(F.col("tick_volume") == 0).alias("zeros"), outliers.alias("outliers"),
        r(F.avg("spread")).alias("spread_mean"), r(F.min("spread")).alias("spread_min"), r(F.max("spread")).alias("spread_max"), F.count_if(F.col("spread") < 0).alias("spread_negatives"),
        ((F.count_if(F.col("tick_volume") < 0) == 0) & (F.count_if(F.col("spread") < 0) == 0)).alias("passed"),
    )


def price_continuity(bars: DataFrame, least: int = 10) -> DataFrame:
    """Jumps from close to open; the autocorrelation of returns where there are more than `least` of them."""
    p = F.lag("close").over(W())
    ret = pct_change("close")
    t = bars.select("symbol", "time", F.abs(F.try_divide(F.col("open") - p, p)).alias("jump"), ret.alias("ret")).withColumn("ret1", F.lag("ret").over(W()))
    auto = F.when(F.count("ret") > least, r(correlation("ret", "ret1"), 4))
    return t.groupBy("symbol").agg(F.count_if(F.col("jump") > 0.02).alias("over_2pct"), F.count_if(F.col("jump") > 0.05).alias("over_5pct"), r(F.max("jump"), 4).alias("max_jump"), r(F.avg("jump"), 4).alias("mean_jump"), auto.alias("autocorrelation"), (F.count_if(F.col("jump") > 0.05) == 0).alias("passed"))


def m5_consistency(bars: DataFrame, expected: float = 5.0, tolerance: float = 0.1) -> DataFrame:
    d = bars.select("symbol", minutes_since_previous().alias("d"))
    lo, hi = expected * (1 - tolerance), expected * (1 + tolerance)
    good = F.count_if(F.col("d").between(lo, hi))
    return d.groupBy("symbol").agg(F.count("d").alias("n"), good.alias("consistent"), F.count_if(F.col("d") < lo).alias("short"), F.count_if(F.col("d") > hi).alias("long"), r(F.percentile("d", 0.5)).alias("median"), (good >= 0.95 * F.count("d")).alias("passed"))


def monotonicity(rows: DataFrame, seq: str = "seq") -> DataFrame:
    """Non-decreasing time in ingest order; needs the ingest number."""
    t = rows.select("symbol", "time", (F.lag("time").over(Window.partitionBy("symbol").orderBy(seq)) > F.col("time")).alias("back"))
    return t.groupBy("symbol").agg(F.count_if("back").alias("backward"), (F.count("*") - F.count_distinct("time")).alias("duplicate_times"), (F.count_if("back") == 0).alias("monotonic"))


def temporal_coverage(bars: DataFrame, per_day: int) -> DataFrame:
    daily = bars.groupBy("symbol", F.to_date("time").alias("d")).agg(F.count("*").alias("n"))
    n = F.col("n")
    return daily.groupBy("symbol").agg(F.count("*").alias("days"), F.count_if(n == per_day).alias("perfect"), F.count_if((n >= 0.9 * per_day) & (n != per_day)).alias("good"), F.count_if((n >= 0.7 * per_day) & (n < 0.9 * per_day)).alias("acceptable"), F.count_if(n < 0.7 * per_day).alias("poor"))


def market_validation(bars: DataFrame) -> DataFrame:
    weekend = F.weekday("time") > 4
    t = local()
    outside = ~((F.weekday(t) < 5) & (F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)).between(34200, 57600))
    return bars.groupBy("symbol").agg(F.count_if(weekend).alias("weekend_rows"), F.count_if(outside).alias("outside_rows"), r(100.0 * F.count_if(~outside) / F.count("*")).alias("pct_valid"))


def flags(bars: DataFrame) -> DataFrame:
    imp = F.col("data_origin").contains("IMPUTADO")
    runs = islands(bars, imp).groupBy("symbol").agg(F.max("length").alias("longest_imputed"))
    return bars.groupBy("symbol").agg(r(100.0 * F.count_if(~imp) / F.count("*")).alias("real_pct"), r(100.0 * F.count_if(imp) / F.count("*")).alias("imputed_pct")).join(runs, "symbol", "left").withColumn("longest_imputed", F.coalesce("longest_imputed", F.lit(0)).cast("long"))


def null_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    one = df.agg(F.count("*").alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return one.unpivot(["__n"], cols, "column_name", "nulls").select("column_name", "nulls", r(100.0 * F.col("nulls") / F.col("__n")).alias("pct"))


def moments(bars: DataFrame, col: str, deviations: float = 20.0) -> DataFrame:
    """Bias-corrected sample skewness and kurtosis, and the share of values beyond so many deviations."""
    n, g1, g2 = F.count(col), F.skewness(col), F.kurtosis(col)
    s = bars.groupBy(F.col("symbol").alias("s_symbol")).agg(F.stddev_samp(col).alias("s_std"))
    t = bars.join(s, F.col("symbol").eqNullSafe(F.col("s_symbol")))
    far = 100.0 * F.count_if((F.abs(col) > deviations * F.col("s_std")) & (F.col("s_std") > 0)) / F.count("*")
    return t.groupBy("symbol").agg(r(F.avg(col), 4).alias("mean"), r(F.stddev_samp(col), 4).alias("std"), r(g1 * F.sqrt(n * (n - 1)) / (n - 2), 4).alias("skew"), r((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6), 4).alias("kurt"), r(far).alias("far_pct"))


def checklist_score(bars: DataFrame, split: DataFrame | None = None) -> DataFrame:
    """100 less ten deductions, at least 0, with status. Coverage: days with bars over weekdays from the first to the last.

    split: (symbol, time, role) labels; training rows at or after the first validation row are an overlap.
    """
    from .analysis import business_days, split_checks
    from .features import returns

    imp = F.col("data_origin").contains("IMPUTADO")
    bad = (F.col("high") < F.col("low")) | (F.col("high") < F.greatest("open", "close")) | (F.col("low") > F.least("open", "close"))
    cells = ("open", "high", "low", "close", "tick_volume", "real_volume", "spread")
    empty = sum((F.col(c).isNull().cast("int") for c in cells), F.lit(0))
    t = bars.withColumns({"__d": minutes_since_previous(), "__lr": returns()["log_return"], "__empty": empty})
    date = F.to_date("time")
    a = t.groupBy("symbol").agg(
        F.count("*").alias("n"), (F.count("*") - F.count_distinct("time")).alias("dups"), F.count_if(F.weekday("time") > 4).alias("weekend"), F.count_if(~checklist_hours()).alias("outside"), F.count_if(bad).alias("ohlc"), F.count_if(F.col("__d") > 5).alias("gaps"),
        r(100.0 * F.sum("__empty") / (F.count("*") * len(cells))).alias("null_pct"), (100.0 * F.count_if(~imp) / F.count("*")).alias("real"), F.coalesce(F.try_divide(F.count_distinct(date).cast("double"), business_days(F.min(date), F.max(date)).cast("double")), F.lit(0.0)).alias("cov"),
    )
    far = moments(t.select("symbol", "__lr"), "__lr").select(F.col("symbol").alias("f_symbol"), "far_pct")
    a = a.join(far, F.col("symbol").eqNullSafe(F.col("f_symbol")))
    overlap = split_checks(split.withColumn("split_id", F.lit(0))).select(F.col("symbol").alias("o_symbol"), "overlap") if split is not None else None
    a = a.join(overlap, F.col("symbol").eqNullSafe(F.col("o_symbol")), "left").withColumn("overlap", F.coalesce("overlap", F.lit(False))) if overlap is not None else a.withColumn("overlap", F.lit(False))
    take = lambda cond, points: F.when(cond, points).otherwise(0.0)
    score = 100.0 - take(F.col("dups") > 0, 10.0) - take(F.col("weekend") > 0, 15.0) - take(F.col("outside") > 0, 10.0) - take(F.col("null_pct") > 5, 10.0) - take(F.col("ohlc") > 0, 20.0) - take(F.col("gaps") > 100, 5.0)
    score = score - take(F.col("far_pct") > 1, 5.0) - take(F.col("overlap"), 15.0) - F.greatest(F.lit(0.0), (0.8 - F.col("cov")) * 50) - F.greatest(F.lit(0.0), (80 - F.col("real")) * 0.5)
    a = a.withColumn("score", r(F.greatest(F.lit(0.0), score), 4))
    s = F.col("score")
    return a.select("symbol", "n", "dups", "weekend", "outside", "ohlc", "gaps", "null_pct", "far_pct", "overlap", "score", F.when(s >= 90, "EXCELLENT").when(s >= 80, "GOOD").when(s >= 70, "ACCEPTABLE").when(s >= 60, "POOR").otherwise("FAILED").alias("status"))


def reporter_grade(completeness: Column, integrity: Column, consistency: Column) -> Column:
    s = 0.5 * completeness + 0.3 * integrity + 0.2 * consistency
    out = F.lit("F")
    for low, g in ((60, "D"), (70, "C"), (75, "C+"), (80, "B"), (85, "B+"), (90, "A"), (95, "A+")):
        out = F.when(s >= low, g).otherwise(out)
    return out


def imputation_days(bars: DataFrame, over_pct: float = 2.0) -> DataFrame:
    imp = F.count_if(F.col("data_origin").contains("IMPUTADO"))
    return bars.groupBy("symbol", F.to_date("time").alias("date")).agg(F.count("*").alias("n"), imp.alias("imputed"), r(100.0 * imp / F.count("*")).alias("pct")).where(F.col("pct") > over_pct)
