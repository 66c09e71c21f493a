"""Analyses of completeness, gaps, sources and imputation; combined validators with verdicts. One aggregate each, rows a symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import quality
from .gaps import minutes
from .quality import r
from .sessions import minutes_since_previous


def imputed(col: str = "data_origin") -> Column:
    return F.coalesce(F.col(col).contains("IMPUTADO"), F.lit(False))


def source_label(origin: Column | str = "data_origin", flag: Column | None = None) -> Column:
    """A readable source of an origin, or of the older flag where there is no origin."""
    o = F.col(origin) if isinstance(origin, str) else origin
    part = F.regexp_extract(o, "^M5_AGREGADO_(M1|M10|M15|M20|M30|H1)$", 1)
    label = F.when(o == "M5_NATIVO", "M5").when(o == "M1_NATIVO", "M1").when(part != "", F.concat(part, F.lit("->M5"))).when(o.contains("IMPUTADO"), "imputed").when(o == "TICKS_NATIVO", "ticks").otherwise(o)
    if flag is None:
        return label
    old = F.regexp_extract(flag, "^aggregated_(m1|m10|m15|m20|m30|h1)$", 1)
    return F.coalesce(label, F.when(flag == "real_m5", "M5").when(old != "", F.concat(F.upper(old), F.lit("->M5"))).when(flag == "imputed", "imputed").otherwise("unknown"))


def source_counts(bars: DataFrame) -> DataFrame:
    """(symbol, year, month, source, n, share): the maps of a tracker, a row an entry."""
    n = bars.groupBy("symbol", F.year("time").alias("year"), F.month("time").alias("month"), source_label().alias("source")).agg(F.count("*").alias("n"))
    return n.withColumn("share", r(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("symbol", "year", "month"))))


def captures_by_hour(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol", F.year("time").alias("year"), F.hour("time").alias("hour")).agg(F.count("*").alias("captured"))


def imputation_log(bars: DataFrame) -> DataFrame:
    """(symbol, date, method, n): rows with an imputed origin."""
    return bars.where(imputed()).groupBy("symbol", F.to_date("time").alias("date"), F.col("data_origin").alias("method")).agg(F.count("*").alias("n"))


def weekday_expected(date: Column, per_day: int = 78) -> Column:
    """Bars expected without a calendar: all weekdays alike."""
    return F.when(F.weekday(date) < 5, per_day).otherwise(0)


def calendar_coverage(bars: DataFrame, calendar: DataFrame) -> DataFrame:
    """(symbol, date, expected, actual, completeness, grade) for each day of a symbol's span, by the calendar's bars.

    The calendar is a row a day: small whatever the bars' size.
    """
    actual = bars.groupBy("symbol", F.to_date("time").alias("date")).agg(F.count("*").alias("n"))
    span = actual.groupBy("symbol").agg(F.min("date").alias("a"), F.max("date").alias("z"))
    days = F.broadcast(calendar.select(F.col("date").alias("date"), F.col("expected_bars").alias("expected"))).join(span, F.col("date").between(F.col("a"), F.col("z"))).select("symbol", "date", "expected")
    t = days.join(actual, ["symbol", "date"], "left").select("symbol", "date", "expected", F.coalesce("n", F.lit(0)).cast("long").alias("actual"))
    pct = F.when(F.col("expected") > 0, r(100.0 * F.col("actual") / F.col("expected"))).otherwise(0.0)
    grade = F.when(F.col("completeness") >= 95, "A").when(F.col("completeness") >= 90, "B").when(F.col("completeness") >= 80, "C").otherwise("D")
    return t.withColumn("completeness", pct).withColumn("grade", F.when(F.col("expected") > 0, grade))


def month_completeness(coverage: DataFrame) -> DataFrame:
    m = coverage.groupBy("symbol", F.date_format("date", "yyyy-MM").alias("month")).agg(F.sum("actual").alias("actual"), F.sum("expected").cast("long").alias("expected"))
    return m.withColumn("completeness", F.when(F.col("expected") > 0, r(100.0 * F.col("actual") / F.col("expected"))))


def daily_analysis(bars: DataFrame, per_day: int = 78) -> DataFrame:
    """(symbol, date, expected, captured, completeness, primary_source, likely_cause); ties of sources by name."""
    n = bars.groupBy("symbol", F.to_date("time").alias("date"), source_label().alias("source")).agg(F.count("*").alias("n"))
    d = n.groupBy("symbol", "date").agg(F.sum("n").alias("captured"), F.min(F.struct((-F.col("n")).alias("n"), "source")).alias("top"))
    expected = weekday_expected(F.col("date"), per_day)
    d = d.select("symbol", "date", expected.alias("expected"), "captured", F.when(expected > 0, r(100.0 * F.col("captured") / expected)).otherwise(0.0).alias("completeness"), F.col("top.source").alias("primary_source"))
    c = F.col("completeness")
    cause = F.when(c < 50, "Posible festivo o cierre").when(c >= 90, "Normal").when(F.date_format("date", "yyyy-MM") == "2020-03", "COVID-19 volatilidad").when(F.col("primary_source") != "M5", "M5 no disponible").otherwise("Gap en datos")
    return d.withColumn("likely_cause", cause)


def completeness_stats(daily: DataFrame) -> DataFrame:
    c = F.col("completeness")
    return daily.groupBy("symbol").agg(r(F.avg(c)).alias("mean"), r(F.min(c)).alias("min"), r(F.max(c)).alias("max"), r(F.stddev_pop(c), 4).alias("std"), F.count_if(c >= 100).alias("days_100"), F.count_if(c >= 95).alias("days_95"), F.count_if(c < 90).alias("days_below_90"))


def hourly_extremes(bars: DataFrame, expected_per_day: int = 12, k: int = 3) -> DataFrame:
    """One row: the k hours of least and most completeness (a top-k report) and flags for opening, closing and lunch."""
    days = F.count_distinct(F.to_date("time"))
    h = bars.groupBy(F.hour("time").alias("hour")).agg(F.count("*").alias("n"), days.alias("d")).select("hour", (100.0 * F.col("n") / (F.col("d") * expected_per_day)).alias("pct"))
    ranked = F.array_sort(F.collect_list(F.struct("pct", "hour")))  # at most 24 rows
    one = h.agg(ranked.alias("x"), *[F.coalesce(F.bool_or(F.col("hour").isin(*hours) & (F.col("pct") < low)), F.lit(False)).alias(name) for name, hours, low in (("opening_issues", (9,), 90), ("closing_issues", (15,), 90), ("lunch_pattern", (12, 13), 95))])
    return one.select(F.array_join(F.transform(F.slice("x", 1, k), lambda s: s["hour"].cast("string")), ",").alias("lowest"), F.array_join(F.transform(F.slice("x", F.greatest(F.size("x") - k + 1, F.lit(1)), k), lambda s: s["hour"].cast("string")), ",").alias("highest"), "opening_issues", "closing_issues", "lunch_pattern")


def summary(bars: DataFrame, per_day: int = 78) -> DataFrame:
    """(symbol, total, imputed, imputation_rate, days, years, sources, completeness)."""
    days = F.count_distinct(F.to_date("time"))
    weekdays = F.count_distinct(F.when(F.weekday("time") < 5, F.to_date("time")))
    return bars.groupBy("symbol").agg(F.count("*").alias("total"), F.count_if(imputed()).alias("imputed"), r(100.0 * F.count_if(imputed()) / F.count("*")).alias("imputation_rate"), days.alias("days"), F.count_distinct(F.year("time")).alias("years"), F.count_distinct(source_label()).alias("sources"), r(100.0 * F.try_divide(F.count("*").cast("double"), (weekdays * per_day).cast("double"))).alias("completeness"))


def gap_analysis(gap_events: DataFrame) -> DataFrame:
    """(size, n, minutes, filled, fill_rate, variance, variance_per_fill) of gap events (gap_minutes, filled_by, variance)."""
    m = F.col("gap_minutes")
    size = F.when(m <= 10, "small (<=10 min)").when(m <= 30, "medium (11-30 min)").when(m <= 60, "large (31-60 min)").otherwise("very large (>60 min)")
    filled = F.count("filled_by")
    return gap_events.groupBy(size.alias("size")).agg(F.count("*").alias("n"), F.sum("gap_minutes").alias("minutes"), filled.alias("filled"), r(100.0 * filled / F.count("*")).alias("fill_rate"), r(F.coalesce(F.sum("variance"), F.lit(0.0)), 4).alias("variance"), r(F.try_divide(F.sum("variance"), filled), 4).alias("variance_per_fill"))


def fill_methods(gap_events: DataFrame) -> DataFrame:
    return gap_events.where("filled_by IS NOT NULL").groupBy("filled_by").agg(F.count("*").alias("n"))


def origin_distribution(bars: DataFrame, known: tuple[str, ...]) -> DataFrame:
    """(data_origin, n, share, mean, min, max, std, valid) of each origin's quality scores."""
    n = bars.groupBy("data_origin").agg(F.count("*").alias("n"), r(F.avg("quality_score")).alias("mean"), r(F.min("quality_score")).alias("min"), r(F.max("quality_score")).alias("max"), r(F.stddev_samp("quality_score"), 4).alias("std"))
    total = F.broadcast(bars.agg(F.count("*").alias("total")))
    return n.join(total, F.lit(True)).select("data_origin", "n", r(100.0 * F.col("n") / F.col("total")).alias("share"), "mean", "min", "max", "std", F.coalesce(F.col("data_origin").isin(*known), F.lit(False)).alias("valid"))


# Validators.


def market_checks(bars: DataFrame) -> DataFrame:
    """(symbol, hours_ok, m5_ok, flags_ok, overall): nothing outside of hours or on weekends, 95 % of the intervals between
    4.9 and 5.1 minutes, 80 % of the rows not imputed."""
    hours = quality.market_validation(bars).select("symbol", ((F.col("weekend_rows") == 0) & (F.col("outside_rows") == 0)).alias("hours_ok"))
    t = bars.withColumn("d", minutes_since_previous())
    rest = t.groupBy("symbol").agg(F.coalesce(F.count_if(F.col("d").between(4.9, 5.1)) >= 0.95 * F.count("d"), F.lit(False)).alias("m5_ok"), (F.count_if(~imputed()) >= 0.8 * F.count("*")).alias("flags_ok"))
    return hours.join(rest, "symbol").withColumn("overall", F.col("hours_ok") & F.col("m5_ok") & F.col("flags_ok"))


def flag_checks(bars: DataFrame, longest: int = 50) -> DataFrame:
    """`quality.flags` with its verdict: 80 % real rows, and no longer run of imputed ones."""
    return quality.flags(bars).withColumn("passed", (F.col("real_pct") >= 80) & (F.col("longest_imputed") <= longest))


def integrity_checks(bars: DataFrame) -> DataFrame:
    """All integrity validators: (symbol, ohlc_ok, volume_ok, continuity_ok, flags_ok, overall)."""
    parts = [
        quality.ohlc_integrity(bars).select("symbol", ((F.col("order_violations") == 0) & (F.col("non_positive") == 0)).alias("ohlc_ok")),
        quality.volume_integrity(bars).select("symbol", F.col("passed").alias("volume_ok")),
        quality.price_continuity(bars).select("symbol", F.col("passed").alias("continuity_ok")),
        flag_checks(bars).select("symbol", F.col("passed").alias("flags_ok")),
    ]
    t = parts[0]
    for p in parts[1:]:
        t = t.join(p, "symbol")
    return t.withColumn("overall", F.col("ohlc_ok") & F.col("volume_ok") & F.col("continuity_ok") & F.col("flags_ok"))


def temporal_checks(bars: DataFrame, per_day: int, seq: str = "seq") -> DataFrame:
    """(symbol, interval_ok, order_ok, perfect_days, overall)."""
    a = quality.m5_consistency(bars).select("symbol", F.col("passed").alias("interval_ok"))
    b = quality.monotonicity(bars, seq).select("symbol", (F.col("monotonic") & (F.col("duplicate_times") == 0)).alias("order_ok"))
    c = quality.temporal_coverage(bars, per_day).select("symbol", F.col("perfect").alias("perfect_days"))
    return a.join(b, "symbol").join(c, "symbol").withColumn("overall", F.col("interval_ok") & F.col("order_ok"))


def first_gaps(bars: DataFrame, over: float = 7.5, k: int = 10) -> DataFrame:
    """The first k gaps in time (a report of examples)."""
    before = F.lag("time").over(Window.partitionBy("symbol").orderBy("time"))
    t = bars.select("symbol", before.alias("gap_start"), F.col("time").alias("gap_end")).withColumn("gap_minutes", minutes(F.col("gap_start"), F.col("gap_end")))
    return t.where(F.col("gap_minutes") > over).orderBy("gap_start", "symbol").limit(k)


def coverage_histograms(bars: DataFrame) -> DataFrame:
    """(symbol, kind, bin, n): rows by weekday and by hour in one pass."""
    both = F.explode(F.array(F.struct(F.lit("weekday").alias("kind"), F.weekday("time").alias("bin")), F.struct(F.lit("hour").alias("kind"), F.hour("time").alias("bin")))).alias("x")
    return bars.select("symbol", both).groupBy("symbol", "x.kind", "x.bin").agg(F.count("*").alias("n"))


def capture_integrity(bars: DataFrame) -> DataFrame:
    """One row a symbol: negatives, impossible bars, gaps over 10 and 60 minutes, repeated times, a range over half the mean,
    nulls, price statistics, and whether the bars are valid."""
    o, h, low, c = (F.col(x) for x in ("open", "high", "low", "close"))
    bad = (h < low) | (o < low) | (o > h) | (c < low) | (c > h)
    t = bars.withColumn("d", minutes_since_previous())
    d = F.col("d")
    a = t.groupBy("symbol").agg(
        F.count("*").alias("n"), F.count_if(F.least(o, h, low, c) < 0).alias("negatives"), F.count_if(bad).alias("bad_bars"),
        F.count_if(d > 10).alias("large_gaps"), r(F.max(F.when(d > 10, d))).alias("largest_gap"), r(F.avg(F.when(d > 10, d))).alias("mean_large_gap"), F.count_if(d > 60).alias("extreme_gaps"),
        (F.count("*") - F.count_distinct("time")).alias("repeated_times"), (F.max(h) - F.min(low) > 0.5 * F.avg(c)).alias("wide_range"), sum((F.count_if(x.isNull()) for x in (o, h, low, c)), F.lit(0)).cast("long").alias("nulls"),
        r(F.min(c)).alias("close_min"), r(F.max(c)).alias("close_max"), r(F.avg(c)).alias("close_mean"), r(F.stddev_samp(c), 4).alias("close_std"),
    )
    return a.withColumn("valid", (F.col("negatives") == 0) & (F.col("bad_bars") == 0))


def business_days(first: Column, last: Column) -> Column:
    """Weekdays between two dates, both included: whole weeks, and what is left of the last one."""
    n = F.date_diff(last, first) + 1
    rest, start = n % 7, F.weekday(first)
    return F.floor(n / 7) * 5 + rest - F.greatest(F.lit(0), F.least(start + rest, F.lit(7)) - F.greatest(F.lit(5), start))


def checklist_coverage(bars: DataFrame, per_day: int) -> DataFrame:
    """(symbol, trading_days, expected_days, coverage, repeated_times, perfect, good, acceptable, poor)."""
    span = bars.groupBy("symbol").agg(F.count_distinct(F.to_date("time")).alias("trading_days"), business_days(F.min(F.to_date("time")), F.max(F.to_date("time"))).cast("long").alias("expected_days"), (F.count("*") - F.count_distinct("time")).alias("repeated_times"))
    classes = quality.temporal_coverage(bars, per_day).drop("days")
    return span.withColumn("coverage", r(F.coalesce(F.try_divide(F.col("trading_days").cast("double"), F.col("expected_days").cast("double")), F.lit(0.0)))).join(classes, "symbol")


# Features a checklist counts, by category.
CHECKLIST_FEATURES = {"price": "open high low close", "volume": "tick_volume volume_sma_20 volume_relative", "technical": "ema_9 ema_21 ema_55 macd rsi_14 rsi_28", "temporal": "hour_sin hour_cos minute_sin minute_cos", "session": "session_progress is_first_30min is_last_30min"}


def features_by_category(df: DataFrame) -> DataFrame:
    """(category, n_features): by the schema alone."""
    rows = [(k, sum(c in df.columns for c in v.split())) for k, v in CHECKLIST_FEATURES.items()]
    rows.append(("all", sum(c not in ("time", "data_flag", "quality_score") for c in df.columns)))
    return df.sparkSession.createDataFrame(rows, "category string, n_features int")


def split_checks(split: DataFrame) -> DataFrame:
    """(symbol, split_id, train, validation, train_share, overlap): overlap if training reaches into validation."""
    role = F.col("role")
    a = split.groupBy("symbol", "split_id").agg(F.count_if(role == "train").alias("train"), F.count_if(role == "validation").alias("validation"), F.max(F.when(role == "train", F.col("time"))).alias("x"), F.min(F.when(role == "validation", F.col("time"))).alias("y"))
    return a.select("symbol", "split_id", "train", "validation", r(F.col("train") / (F.col("train") + F.col("validation"))).alias("train_share"), F.coalesce(F.col("x") >= F.col("y"), F.lit(False)).alias("overlap"))


def originality(bars: DataFrame, over: float = 0.02) -> DataFrame:
    """(symbol, originality, dates_over): share of rows not imputed, and days with a larger imputed share."""
    day = bars.groupBy("symbol", F.to_date("time").alias("d")).agg(F.count("*").alias("n"), F.count_if(imputed()).alias("k"))
    return day.groupBy("symbol").agg(r(100.0 * (F.sum("n") - F.sum("k")) / F.sum("n")).alias("originality"), F.count_if(F.col("k") > over * F.col("n")).alias("dates_over"))


def reporter_checks(df: DataFrame) -> DataFrame:
    """(check, value, status): a report's checks out of one aggregate and one count of repeated rows."""
    from .preprocess import numeric, quality_metrics

    cols = numeric(df)
    m = quality_metrics(df).select("n_rows", "nulls", "flat_columns", "bad_bars", "repeated_rows")
    stats = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)], *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(cols)])
    far = sum((F.coalesce((F.abs(F.col(c) - F.col(f"m{i}")) > 5 * F.col(f"s{i}")) & (F.col(f"s{i}") > 0), F.lit(False)).cast("int") for i, c in enumerate(cols)), F.lit(0))
    far = df.join(F.broadcast(stats), F.lit(True)).agg(F.sum(far).cast("long").alias("far"), F.date_diff(F.max(F.to_date("time")), F.min(F.to_date("time"))).alias("days"), F.count_if(F.col("tick_volume") < 0).alias("negative"))
    t = m.join(F.broadcast(far), F.lit(True))
    essential = sum(c not in df.columns for c in ("open", "high", "low", "close", "volume"))
    checks = [
        ("no_duplicates", F.col("repeated_rows"), F.col("repeated_rows") == 0, "FAIL"), ("no_missing_values", F.col("nulls"), F.col("nulls") == 0, "WARN"), ("numeric_columns", F.lit(len(cols)), F.lit(len(cols) > 10), "WARN"),
        ("temporal_coverage", F.col("days"), F.col("days") > 30, "WARN"), ("no_zero_variance", F.col("flat_columns"), F.col("flat_columns") == 0, "WARN"), ("essential_features", F.lit(essential), F.lit(essential == 0), "FAIL"),
        ("extreme_outliers", F.col("far"), F.col("far") < 0.01 * F.col("n_rows"), "WARN"), ("ohlcv_integrity", F.col("bad_bars"), F.col("bad_bars") == 0, "FAIL"), ("non_negative_volume", F.col("negative"), F.col("negative") == 0, "FAIL"),
    ]
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("check"), v.cast("long").alias("value"), F.when(ok, "PASS").otherwise(bad).alias("status")) for n, v, ok, bad in checks])).alias("x")
    return t.select(rows).select("x.*")


def reporter_score(checks: DataFrame, completeness: Column, consistency: Column) -> DataFrame:
    """(integrity, score, grade) out of a report's checks: the share that passed weighs 0.3."""
    one = checks.agg((100.0 * F.count_if(F.col("status") == "PASS") / F.count("*")).alias("integrity"))
    score = 0.5 * completeness + 0.3 * F.col("integrity") + 0.2 * consistency
    return one.select(r(F.col("integrity"), 4).alias("integrity"), r(score, 4).alias("score"), quality.reporter_grade(completeness, F.col("integrity"), consistency).alias("grade"))


def recommendations(checks: DataFrame) -> DataFrame:
    """(check, priority, advice) for each check that did not pass."""
    advice = {"no_duplicates": "Remove repeated rows.", "no_missing_values": "Fill or drop missing values.", "numeric_columns": "Add features.", "temporal_coverage": "Capture a longer period.", "no_zero_variance": "Drop constant columns.", "essential_features": "Add the missing columns.", "extreme_outliers": "Treat extreme values.", "ohlcv_integrity": "Repair impossible bars.", "non_negative_volume": "Clamp negative volumes."}
    names = F.create_map(*[F.lit(x) for pair in advice.items() for x in pair])
    return checks.where("status <> 'PASS'").select("check", F.when(F.col("status") == "FAIL", "HIGH").otherwise("MEDIUM").alias("priority"), F.try_element_at(names, F.col("check")).alias("advice"))
