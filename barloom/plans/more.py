"""Registered queries of whole cleaning, normalising and selecting steps, capture, analyses and combined validators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import LISTED_HOLIDAYS, calendar_table, expected_bars, holiday_list, holiday_sources, us_holidays
from ..functions.catalog import DATA_ORIGINS
from ..operators import analysis, capture, clean, features, gaps, lineage, preprocess, quality, resample
from ..sources.tables import conform, read_table
from .registry import (
    ATR_PARTS, BAD, C1, CHG1, DIFF, GAPS_SQL, I_SQL, LEGACY_SOURCES, OUTSIDE, RET, SOURCED, SPANS, SQL, W, bars, bars_sql, featured_digits, flagged, full_sql, inside, labels, register, rounded, rounds, sourced, two_sources,
)

HOURLY = bars_sql("1 hour")

# Cleaning by category: holes are planted by the hour.
HOLES = {"close": ("hour(time) % 5 <> 0", "close"), "tick_volume": ("hour(time) % 7 <> 1", "tick_volume::DOUBLE"), "log_return": ("hour(time) % 3 <> 0", "lr"), "extra": ("hour(time) % 4 <> 2", "open"), "hour_sin": ("hour(time) % 6 <> 3", "high")}
HOLED_SQL = f"h AS (SELECT symbol, time, {', '.join(f'CASE WHEN {c} THEN {e} END AS {n}' for n, (c, e) in HOLES.items())} FROM (SELECT *, {RET['log_return']} AS lr FROM b))"


def holed_bars(spark, sf):
    t = features.add(bars(spark, sf, "1 hour"), features.returns())
    h = F.hour("time")
    return t.select("symbol", "time", F.when(h % 5 != 0, F.col("close")).alias("close"), F.when(h % 7 != 1, F.col("tick_volume").cast("double")).alias("tick_volume"), F.when(h % 3 != 0, F.col("log_return")).alias("log_return"), F.when(h % 4 != 2, F.col("open")).alias("extra"), F.when(h % 6 != 3, F.col("high")).alias("hour_sin"))


PAST, NEXT = "(PARTITION BY symbol ORDER BY time ROWS UNBOUNDED PRECEDING)", "(PARTITION BY symbol ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


def forward_sql(c: str) -> str:
    return f"coalesce(last_value({c} IGNORE NULLS) OVER {PAST}, first_value({c} IGNORE NULLS) OVER {NEXT}, 0)"


@register("clean_nulls", f"""WITH {HOURLY}, {HOLED_SQL}, n AS (SELECT *, row_number() OVER {W} AS rn, CASE WHEN close IS NOT NULL THEN row_number() OVER {W} END AS kn FROM h),
p AS (SELECT *, last_value(close IGNORE NULLS) OVER {PAST} AS pv, last_value(kn IGNORE NULLS) OVER {PAST} AS pr, first_value(close IGNORE NULLS) OVER {NEXT} AS nv, first_value(kn IGNORE NULLS) OVER {NEXT} AS nr FROM n)
SELECT symbol, time, round(coalesce(close, pv + (nv - pv) * (rn - pr) / nullif(nr - pr, 0), pv, nv, 0), 6) AS close, round({forward_sql('tick_volume')}, 6) AS tick_volume, round(coalesce(log_return, 0), 6) AS log_return, round({forward_sql('extra')}, 6) AS extra, round({forward_sql('hour_sin')}, 6) AS hour_sin FROM p""")
def _(spark, sf):
    return rounded(preprocess.clean_nulls(holed_bars(spark, sf)), list(HOLES))


HOW = {"close": "interpolate", "tick_volume": "forward", "log_return": "zero", "extra": "forward", "hour_sin": "none"}


@register("null_report", f"WITH {HOURLY}, {HOLED_SQL} " + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS original_nulls, round(100.0 * (count(*) - count({c})) / count(*), 6) AS pct, '{m}' AS method FROM h HAVING count(*) > count({c})" for c, m in HOW.items()))
def _(spark, sf):
    return preprocess.null_report(holed_bars(spark, sf))


@register("mean_fill", f"WITH {HOURLY}, {HOLED_SQL} SELECT symbol, time, round(coalesce(extra, avg(extra) OVER (PARTITION BY symbol)), 6) AS extra FROM h")
def _(spark, sf):
    return rounded(preprocess.mean_fill(holed_bars(spark, sf), "extra"), ["extra"])


def wide_bars(spark, sf):
    t = features.add(bars(spark, sf, "1 hour"), features.returns(), features.sma_family((20,)))
    return t.select("symbol", "time", "log_return", "sma_20", F.col("tick_volume").cast("double").alias("tick_volume"))


WIDE_SQL = f"w AS (SELECT symbol, time, {RET['log_return']} AS log_return, avg(close) OVER (PARTITION BY symbol ORDER BY time ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS sma_20, tick_volume::DOUBLE AS tick_volume FROM b)"
BOUNDS = "k AS (SELECT quantile_cont(log_return, 0.001) AS ra, quantile_cont(log_return, 0.999) AS rb, avg(sma_20) - 1.5 * stddev_samp(sma_20) AS sa, avg(sma_20) + 1.5 * stddev_samp(sma_20) AS sb, min(tick_volume) AS va FROM w)"


@register("handle_outliers", f"WITH {HOURLY}, {WIDE_SQL}, {BOUNDS} SELECT symbol, time, round(greatest(ra, least(rb, log_return)), 6) AS log_return, round(greatest(sa, least(sb, sma_20)), 6) AS sma_20, round(CASE WHEN va >= 0 THEN ln(1 + tick_volume) ELSE tick_volume END, 6) AS tick_volume FROM w, k")
def _(spark, sf):
    t = preprocess.handle_outliers(wide_bars(spark, sf), 1.5)
    return t.select("symbol", "time", F.round("log_return", 6).alias("log_return"), F.round("sma_20", 6).alias("sma_20"), F.round("tick_volume", 6).alias("tick_volume"))


@register("outlier_report", f"WITH {HOURLY}, {WIDE_SQL}, {BOUNDS} SELECT 'log_return' AS column_name, 'winsorize' AS treatment, count(*) FILTER (WHERE log_return < ra OR log_return > rb) AS n_outliers, round(100.0 * count(*) FILTER (WHERE log_return < ra OR log_return > rb) / count(*), 6) AS pct FROM w, k UNION ALL SELECT 'sma_20', 'clip', count(*) FILTER (WHERE sma_20 < sa OR sma_20 > sb), round(100.0 * count(*) FILTER (WHERE sma_20 < sa OR sma_20 > sb) / count(*), 6) FROM w, k")
def _(spark, sf):
    return preprocess.outlier_report(wide_bars(spark, sf), 1.5)


NUMERIC = ["open", "high", "low", "close", "tick_volume", "real_volume", "spread"]
PAIRS = " + ".join(f"coalesce((CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE abs(round(corr({a}, {b}), 4)) END > 0.95)::INT, 0)" for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1 :])
TWICE = "t AS (SELECT * FROM b UNION ALL SELECT * FROM b WHERE hour(time) = 3)"


def repeated_bars(spark, sf):
    b = bars(spark, sf, "1 hour")
    return b.unionByName(b.where(F.hour("time") == 3))


@register("quality_metrics", f"WITH {HOURLY}, {TWICE}, r AS (SELECT sum(k - 1)::BIGINT AS repeated_rows FROM (SELECT count(*) AS k FROM t GROUP BY ALL, symbol, time, {', '.join(NUMERIC)}, data_origin)) SELECT count(*) AS n_rows, 0::BIGINT AS nulls, ({' + '.join(f'coalesce((var_samp({c}) < 1e-10)::INT, 0)' for c in NUMERIC)})::INT AS flat_columns, count(*) FILTER (WHERE {BAD}) AS bad_bars, any_value(repeated_rows) AS repeated_rows, ({PAIRS})::INT AS correlated_pairs FROM t, r".replace("GROUP BY ALL, ", "GROUP BY "))
def _(spark, sf):
    return preprocess.quality_metrics(repeated_bars(spark, sf))


@register("final_cleanup", f"WITH {HOURLY}, {TWICE} SELECT DISTINCT symbol, time, close, tick_volume FROM t")
def _(spark, sf):
    return preprocess.final_cleanup(repeated_bars(spark, sf)).select("symbol", "time", "close", "tick_volume")


@register("full_clean", f"WITH {HOURLY}, {TWICE}, d AS (SELECT DISTINCT symbol, time, close, tick_volume::DOUBLE AS v FROM t) SELECT symbol, time, close, round(ln(1 + v), 6) AS tick_volume FROM d")
def _(spark, sf):
    t = repeated_bars(spark, sf).withColumn("tick_volume", F.col("tick_volume").cast("double"))
    return preprocess.full_clean(t).select("symbol", "time", "close", F.round("tick_volume", 6).alias("tick_volume"))


@register("clean_summary", f"WITH {HOURLY}, {HOLED_SQL}, {TWICE} SELECT count(*) AS rows_before, (5 * count(*) - count(close) - count(tick_volume) - count(log_return) - count(extra) - count(hour_sin))::BIGINT AS nulls_before, count(*) AS rows_after, 0::BIGINT AS nulls_after FROM h")
def _(spark, sf):
    t = holed_bars(spark, sf)
    return preprocess.clean_summary(t, preprocess.final_cleanup(preprocess.clean_nulls(t)))


@register("repair_bars", f"WITH {HOURLY}, x AS (SELECT symbol, time, open, CASE WHEN hour(time) = 2 THEN low - 1 ELSE high END AS high, low, close, CASE WHEN hour(time) = 4 THEN -tick_volume ELSE tick_volume END AS v FROM b) SELECT symbol, time, greatest(high, open, close) AS high, least(low, open, close) AS low, greatest(v, 0) AS tick_volume FROM x")
def _(spark, sf):
    t = repeated_bars(spark, sf)
    t = t.withColumns({"high": F.when(F.hour("time") == 2, F.col("low") - 1).otherwise(F.col("high")), "tick_volume": F.when(F.hour("time") == 4, -F.col("tick_volume")).otherwise(F.col("tick_volume"))})
    return clean.repair_bars(t).select("symbol", "time", "high", "low", "tick_volume")


@register("clean_bars", f"WITH {HOURLY} SELECT symbol, time, close FROM b WHERE hour(time) NOT IN (2, 5)")
def _(spark, sf):
    t = repeated_bars(spark, sf)
    t = t.withColumns({"high": F.when(F.hour("time") == 2, F.col("low") - 1).otherwise(F.col("high")), "close": F.when(F.hour("time") != 5, F.col("close")), "seq": F.col("tick_volume")})
    return clean.clean_bars(t).select("symbol", "time", "close")


@register("conform_schema", f"WITH {HOURLY} SELECT symbol, time, close, tick_volume::INTEGER AS tick_volume, 0.0::DOUBLE AS quality_score, 'unknown' AS capture_method FROM b")
def _(spark, sf):
    return conform(bars(spark, sf, "1 hour").drop("quality_score")).select("symbol", "time", "close", "tick_volume", "quality_score", "capture_method")


# Normalising.


@register("volume_relative", f"WITH {HOURLY}, m AS (SELECT *, CASE WHEN count(*) OVER r >= 10 THEN avg(tick_volume) OVER r END AS mean FROM b WINDOW r AS (PARTITION BY symbol ORDER BY time ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)) SELECT symbol, time, round(ln(1 + tick_volume), 6) AS tick_volume_log, round(ln(1 + tick_volume) / nullif(ln(1 + mean), 0), 6) AS tick_volume, round(real_volume / CASE WHEN mean IS NOT NULL THEN greatest(mean, 1.0) END, 6) AS volume_delta FROM m")
def _(spark, sf):
    t = bars(spark, sf, "1 hour").withColumns({"tick_volume": F.col("tick_volume").cast("double"), "volume_delta": F.col("real_volume").cast("double")})
    return rounded(preprocess.volume_relative(t), ["tick_volume_log", "tick_volume", "volume_delta"])


@register("technical_relative", f"WITH {HOURLY}, t AS (SELECT *, {ATR_PARTS} AS tr FROM b), a AS (SELECT symbol, time, close, close - open AS macd, high - low AS cb_level, {full_sql('avg', 'tr', 14)} AS atr_14 FROM t), k AS (SELECT quantile_cont(cb_level, 0.5) AS m, quantile_cont(cb_level, 0.75) - quantile_cont(cb_level, 0.25) AS w FROM a) SELECT symbol, time, round(macd / greatest(atr_14, 0.001), 6) AS macd, round(atr_14 / nullif(close, 0), 6) AS atr_14, round((cb_level - m) / CASE WHEN w = 0 THEN 1 ELSE w END, 6) AS cb_level FROM a, k")
def _(spark, sf):
    t = features.add(bars(spark, sf, "1 hour"), *features.atr()).withColumns({"macd": F.col("close") - F.col("open"), "cb_level": F.col("high") - F.col("low")})
    return rounded(preprocess.technical_relative(t).select("symbol", "time", "macd", "atr_14", "cb_level"), ["macd", "atr_14", "cb_level"])


@register("feature_specific_norm", f"""WITH {HOURLY}, x AS (SELECT *, {RET['log_return']} AS lr, hour(time) * 10.0 - 60 AS rsi, hour(time) / 12.0 - 0.5 AS sp FROM b), m AS (SELECT *, {full_sql('avg', 'close', 20)} AS mc, {full_sql('avg', 'tick_volume', 20)} AS mv FROM x), s AS (SELECT stddev_samp(lr) AS sd FROM x)
SELECT symbol, time, close, tick_volume, round(coalesce(open / nullif(mc, 0), 1), 6) AS open, round(coalesce(high / nullif(mc, 0), 1), 6) AS high, round(coalesce(low / nullif(mc, 0), 1), 6) AS low, round(coalesce(real_volume / nullif(mv, 0), 1), 6) AS volume_delta, round(greatest(0, least(100, rsi)), 6) AS rsi_14, round(greatest(-10 * sd, least(10 * sd, lr)), 6) AS log_return, round(greatest(0, least(1, sp)), 6) AS session_progress FROM m, s""")
def _(spark, sf):
    t = features.add(bars(spark, sf, "1 hour"), features.returns()).withColumns({"volume_delta": F.col("real_volume"), "rsi_14": F.hour("time") * 10.0 - 60, "session_progress": F.hour("time") / 12.0 - 0.5})
    t = preprocess.feature_specific(t)
    return t.select("symbol", "time", "close", "tick_volume", *[F.round(c, 6).alias(c) for c in ("open", "high", "low", "volume_delta", "rsi_14", "log_return", "session_progress")])


STAT = {"price": ["open", "high", "low", "close"], "volume": ["tick_volume"]}


@register("normalisation_stats", f"WITH {HOURLY} " + " UNION ALL ".join(f"SELECT '{k}' AS category, '{c}' AS column_name, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, round(min({c}), 4)::DOUBLE AS min, round(max({c}), 4)::DOUBLE AS max FROM b" for k, own in STAT.items() for c in own))
def _(spark, sf):
    return preprocess.normalisation_stats(bars(spark, sf, "1 hour"))


@register("scaler_fit_transform", "WITH s AS (SELECT avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS d FROM lineitem WHERE l_linenumber = 1) SELECT l_orderkey, l_linenumber, round((l_extendedprice - m) / d, 6) AS x FROM lineitem, s WHERE l_linenumber <> 1")
def _(spark, sf):
    t = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("x"))
    fitted = clean.Scaler("standard", ["x"]).fit(t.where("l_linenumber = 1"))
    return fitted.transform(t.where("l_linenumber <> 1")).withColumn("x", F.round("x", 6))


# Selecting.


def candidates(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.select(F.col("l_shipdate").alias("time"), F.lit("real").alias("data_flag"), F.col("l_extendedprice").alias("open"), (F.col("l_extendedprice") * 2 + 1).alias("high"), F.col("l_discount").alias("low"), F.col("l_tax").alias("close"), F.lit(1.0).alias("vwap"), (F.col("l_linenumber").cast("double")).alias("unnamed"))


@register("feature_selection", "WITH x AS (SELECT l_extendedprice AS open, l_extendedprice * 2 + 1 AS high, l_discount AS low, l_tax AS close, 1.0::DOUBLE AS vwap, l_linenumber::DOUBLE AS unnamed FROM lineitem), f AS (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, var_pop({c}) <= 1e-5 AS flat, {' OR '.join(f'coalesce(abs(round(corr({c}, {a}), 4)) > 0.95, false)' for a in earlier) or 'false'} AS twin, {str(c != 'unnamed').lower()} AS named FROM x" for c, earlier in (("open", []), ("high", ["open"]), ("low", ["open", "high"]), ("close", ["open", "high", "low"]), ("vwap", []), ("unnamed", ["open", "high", "low", "close"]))) + ") SELECT column_name, CASE WHEN flat THEN 'constant' WHEN twin THEN 'correlated' WHEN named THEN 'selected' ELSE 'not_recommended' END AS step FROM f UNION ALL SELECT * FROM (VALUES ('time', 'selected'), ('data_flag', 'selected'))")
def _(spark, sf):
    return preprocess.selection_table(candidates(spark, sf))


# Capture.
TF4 = "(['M5', 'M1', 'M10', 'ticks'])[(event_id % 4)::INTEGER + 1]"
MULTI = f"s AS (SELECT event_type AS symbol, ts AS time, value AS v, {TF4} AS tf FROM events), m AS (SELECT symbol, time_bucket(INTERVAL '5 minutes', time) AS time, tf, arg_min(v, time) AS open, max(v) AS high, min(v) AS low, arg_max(v, time) AS close, count(*) AS tick_volume, count(*)::BIGINT AS real_volume FROM s GROUP BY 1, 2, 3), p(tf, q) AS (VALUES ('M5', 1.0::DOUBLE), ('ticks', 0.98), ('M1', 0.95), ('M10', 0.85))"


def multi_source(spark, sf):
    e = read_table(spark, sf, "events")
    tf = F.get(F.array(*[F.lit(x) for x in ("M5", "M1", "M10", "ticks")]), (F.col("event_id") % 4).cast("int"))
    one = F.lit(1).cast("long")
    return e.select(F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp_ntz").alias("time"), *[F.col("value").alias(c) for c in capture.PRICES], one.alias("tick_volume"), one.alias("real_volume"), tf.alias("source_timeframe"))


@register("all_to_m5", f"WITH {MULTI} SELECT symbol, time, open, high, low, close, tick_volume, real_volume, tf AS source_timeframe, CASE WHEN tf = 'M5' THEN 'M5_NATIVO' ELSE 'M5_AGREGADO_' || upper(tf) END AS data_origin, q AS quality_score FROM m JOIN p USING (tf) QUALIFY row_number() OVER (PARTITION BY symbol, time ORDER BY q DESC, tf) = 1")
def _(spark, sf):
    return capture.all_to_m5(multi_source(spark, sf))


@register("capture_fallback", "SELECT o_orderdate AS time, o_totalprice AS close, 'M5' AS source_timeframe FROM orders UNION ALL SELECT l_shipdate, l_extendedprice, 'M10' FROM lineitem WHERE l_shipdate NOT IN (SELECT o_orderdate FROM orders)")
def _(spark, sf):
    t = two_sources(spark, sf)
    first, second = t.where("source_timeframe = 'M5'"), t.where("source_timeframe = 'M10'")
    return capture.fallback(first, second).select("time", "close", "source_timeframe")


@register("recapture_gaps", f"WITH {bars_sql()}, {GAPS_SQL}, x AS (SELECT symbol, gap_start, gap_end FROM g WHERE gap_minutes > 60) SELECT b.symbol, b.time, b.close FROM b JOIN x ON b.symbol <> x.symbol AND b.symbol = 'click' AND x.symbol = 'view' AND b.time > x.gap_start AND b.time < x.gap_end")
def _(spark, sf):
    b = bars(spark, sf)
    second = b.where("symbol = 'click'").withColumn("symbol", F.lit("view"))
    return capture.recapture(gaps.detect_gaps(b), b, second).select(F.lit("click").alias("symbol"), "time", "close")


@register("ticks_from", "SELECT event_type AS symbol, ts AS time, value AS price FROM (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-05' ORDER BY ts, event_id LIMIT 500) WHERE ts <= TIMESTAMP '2024-01-06'")
def _(spark, sf):
    return capture.ticks_from(resample.ticks_of_events(read_table(spark, sf, "events")), "2024-01-05", 500, "2024-01-06").select("symbol", "time", "price")


@register("bid_ask_bars", "SELECT event_type AS symbol, time_bucket(INTERVAL '5 minutes', ts) AS time, round(arg_min(value + 0.1, ts), 6) AS open, round(max(value + 0.1), 6) AS high, round(avg(0.2), 6) AS spread FROM events GROUP BY 1, 2")
def _(spark, sf):
    t = resample.ticks_of_events(read_table(spark, sf, "events")).withColumns({"bid": F.col("price"), "ask": F.col("price") + 0.2}).drop("price")
    return resample.ticks_to_bars(resample.mid_price(t)).select("symbol", "time", *[F.round(c, 6).alias(c) for c in ("open", "high", "spread")])


@register("last_price_bars", "SELECT event_type AS symbol, time_bucket(INTERVAL '5 minutes', to_timestamp(epoch(date_trunc('second', ts)))::TIMESTAMP) AS time, arg_min(value, struct_pack(a := date_trunc('second', ts), b := event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, struct_pack(a := date_trunc('second', ts), b := event_id)) AS close, count(*) AS tick_volume, count(*)::BIGINT AS real_volume FROM events GROUP BY 1, 2")
def _(spark, sf):
    t = read_table(spark, sf, "events").select(F.col("event_type").alias("symbol"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("time"), F.col("value").alias("last"), F.lit(1).cast("long").alias("volume"), F.col("event_id").alias("seq"))
    return capture.last_ticks_to_bars(capture.epoch_times(t))


@register("save_check", f"WITH {HOURLY} SELECT count(*) AS n, count(*) FILTER (WHERE hour(time) = 5)::BIGINT AS nulls, 0 AS missing_columns, 2 AS text_columns, count(*) FILTER (WHERE hour(time) = 6) AS negatives FROM b")
def _(spark, sf):
    t = bars(spark, sf, "1 hour").withColumns({"close": F.when(F.hour("time") != 5, F.col("close")), "tick_volume": F.when(F.hour("time") == 6, F.lit(-1).cast("long")).otherwise(F.col("tick_volume"))})
    return capture.save_check(t)


@register("downcast", f"WITH {HOURLY} SELECT symbol, time, close::FLOAT::DOUBLE AS close, tick_volume::INTEGER AS tick_volume, hour(time)::TINYINT AS hour FROM b")
def _(spark, sf):
    t = capture.downcast(bars(spark, sf, "1 hour").withColumn("hour", F.hour("time").cast("long")))
    return t.select("symbol", "time", F.col("close").cast("double").alias("close"), "tick_volume", "hour")


@register("conform_types", f"WITH {HOURLY} SELECT symbol, time, CASE WHEN hour(time) <> 7 THEN close END AS close, open - 1 AS returns FROM b")
def _(spark, sf):
    t = bars(spark, sf, "1 hour").select("symbol", "time", F.when(F.hour("time") != 7, F.format_string("%.17g", "close")).otherwise("n/a").alias("close"), (F.col("open") - 1).alias("return"), F.col("time").alias("time"))
    return capture.conform_types(t)


@register("standard_time", f"WITH {HOURLY} SELECT symbol, strftime(timezone('UTC', timezone('America/New_York', time)), '%Y-%m-%d %H:%M:%S') || '+0000' AS time, close FROM b")
def _(spark, sf):
    return capture.standard_time(bars(spark, sf, "1 hour"), "America/New_York", text=True).select("symbol", "time", "close")


@register("simple_migration", f"WITH {HOURLY} SELECT symbol, time, 'M5_NATIVO' AS data_origin, 1.0::DOUBLE AS quality_score FROM b")
def _(spark, sf):
    return capture.simple_migration(bars(spark, sf, "1 hour")).select("symbol", "time", "data_origin", "quality_score")


# Gaps within market hours, and by the exchange's calendar.


@register("linear_gap_fill_market", f"""WITH {bars_sql()}, p AS (SELECT symbol, time, close, open, lag(time) OVER {W} AS pt, lag(close) OVER {W} AS pc, lag(open) OVER {W} AS po FROM b), q AS (SELECT *, date_diff('minute', pt, time) // 5 - 1 AS n FROM p WHERE date_diff('minute', pt, time) > 7 AND date_diff('minute', pt, time) <= 30 AND {inside('pt')} AND {inside('time')}),
s AS (SELECT *, unnest(range(1, n + 1)) AS i FROM q) SELECT symbol, pt + INTERVAL 5 MINUTE * i AS time, round(po + i / (n + 1.0) * (open - po), 6) AS open, round(pc + i / (n + 1.0) * (close - pc), 6) AS close FROM s""")
def _(spark, sf):
    return rounded(gaps.bridge_fill(bars(spark, sf)), ["open", "close"])


@register("random_walk_fill")
def _(spark, sf):
    return gaps.random_walk_fill(bars(spark, sf), max_minutes=240)


def calendar_values(year: int = 2024) -> str:
    from datetime import date, timedelta

    days = [date(year, 1, 1) + timedelta(days=i) for i in range(366)]
    return "cal(date, expected) AS (VALUES " + ", ".join(f"(DATE '{d}', {expected_bars(d)})" for d in days if d.year == year) + ")"


COVERAGE = f"n AS (SELECT symbol, time::DATE AS date, count(*) AS n FROM b GROUP BY 1, 2), s AS (SELECT symbol, min(date) AS a, max(date) AS z FROM n GROUP BY 1), {calendar_values()}, c AS (SELECT symbol, date, expected, coalesce(n, 0)::BIGINT AS actual FROM cal JOIN s ON date BETWEEN a AND z LEFT JOIN n USING (symbol, date)), v AS (SELECT *, CASE WHEN expected > 0 THEN round(100.0 * actual / expected, 6) ELSE 0 END::DOUBLE AS completeness FROM c)"


@register("calendar_coverage", f"WITH {bars_sql()}, {COVERAGE} SELECT *, CASE WHEN expected > 0 THEN CASE WHEN completeness >= 95 THEN 'A' WHEN completeness >= 90 THEN 'B' WHEN completeness >= 80 THEN 'C' ELSE 'D' END END AS grade FROM v")
def _(spark, sf):
    return analysis.calendar_coverage(bars(spark, sf), calendar_table(spark, 2024, 2024))


@register("month_completeness", f"WITH {bars_sql()}, {COVERAGE} SELECT symbol, strftime(date, '%Y-%m') AS month, sum(actual)::BIGINT AS actual, sum(expected)::BIGINT AS expected, round(100.0 * sum(actual) / sum(expected), 6) AS completeness FROM v GROUP BY 1, 2")
def _(spark, sf):
    return analysis.month_completeness(analysis.calendar_coverage(bars(spark, sf), calendar_table(spark, 2024, 2024)))


def dates(days) -> str:
    return ", ".join(f"(DATE '{d}')" for d in days)


@register("holiday_sources", f"WITH r(date) AS (VALUES {dates(holiday_list(2020, 2025))}), l(date) AS (VALUES {dates(LISTED_HOLIDAYS)}) SELECT coalesce(r.date, l.date) AS date, r.date IS NOT NULL AS by_rule, l.date IS NOT NULL AS listed FROM r FULL JOIN l ON r.date = l.date")
def _(spark, sf):
    return holiday_sources(spark)


@register("holiday_rows", f"WITH {bars_sql()}, l(date) AS (VALUES {dates(sorted(us_holidays(2024)))}) SELECT date, count(*) AS n FROM b JOIN l ON time::DATE = date GROUP BY 1")
def _(spark, sf):
    from ..functions.calendar import holiday_rows

    return holiday_rows(bars(spark, sf))


# Analyses.
LABEL = "CASE WHEN data_origin = 'M5_NATIVO' THEN 'M5' WHEN data_origin = 'M1_NATIVO' THEN 'M1' WHEN regexp_matches(data_origin, '^M5_AGREGADO_(M1|M10|M15|M20|M30|H1)$') THEN substr(data_origin, 13) || '->M5' WHEN contains(data_origin, 'IMPUTADO') THEN 'imputed' WHEN data_origin = 'TICKS_NATIVO' THEN 'ticks' ELSE data_origin END"


def assigned(spark, sf):
    return lineage.assign(sourced(spark, sf))


@register("source_counts", f"WITH {SOURCED}, n AS (SELECT symbol, year(time)::INTEGER AS year, month(time)::INTEGER AS month, {LABEL} AS source, count(*) AS n FROM a GROUP BY ALL) SELECT *, round(100.0 * n / sum(n) OVER (PARTITION BY symbol, year, month), 6) AS share FROM n")
def _(spark, sf):
    return analysis.source_counts(assigned(spark, sf))


@register("source_labels_legacy", f"WITH x AS (SELECT event_id AS seq, {LEGACY_SOURCES} AS f FROM events) SELECT seq, CASE WHEN f = 'real_m5' THEN 'M5' WHEN f IN ('aggregated_m1', 'aggregated_h1') THEN upper(substr(f, 12)) || '->M5' WHEN f = 'imputed' THEN 'imputed' ELSE 'unknown' END AS source FROM x")
def _(spark, sf):
    flag = F.get(F.array(*[F.lit(x) for x in ("real_m5", "aggregated_m1", "aggregated_h1", "imputed", "other")]), (F.col("seq") % 5).cast("int"))
    return sourced(spark, sf).select("seq", analysis.source_label(F.lit(None).cast("string"), flag).alias("source"))


@register("captures_by_hour", f"WITH {SOURCED} SELECT symbol, year(time)::INTEGER AS year, hour(time)::INTEGER AS hour, count(*) AS captured FROM a GROUP BY ALL")
def _(spark, sf):
    return analysis.captures_by_hour(assigned(spark, sf))


@register("imputation_log", f"WITH {SOURCED} SELECT symbol, time::DATE AS date, data_origin AS method, count(*) AS n FROM a WHERE contains(data_origin, 'IMPUTADO') GROUP BY ALL")
def _(spark, sf):
    return analysis.imputation_log(assigned(spark, sf))


DAILY_ANALYSIS = f"n AS (SELECT symbol, time::DATE AS date, {LABEL} AS source, count(*) AS n FROM a GROUP BY ALL), d AS (SELECT symbol, date, CASE WHEN isodow(date) < 6 THEN 78 ELSE 0 END AS expected, sum(n)::BIGINT AS captured, arg_min(source, struct_pack(a := -n, b := source)) AS primary_source FROM n GROUP BY 1, 2), c AS (SELECT symbol, date, expected, captured, CASE WHEN expected > 0 THEN round(100.0 * captured / expected, 6) ELSE 0 END::DOUBLE AS completeness, primary_source FROM d)"


@register("daily_analysis", f"WITH {SOURCED}, {DAILY_ANALYSIS} SELECT *, CASE WHEN completeness < 50 THEN 'Posible festivo o cierre' WHEN completeness >= 90 THEN 'Normal' WHEN strftime(date, '%Y-%m') = '2020-03' THEN 'COVID-19 volatilidad' WHEN primary_source <> 'M5' THEN 'M5 no disponible' ELSE 'Gap en datos' END AS likely_cause FROM c")
def _(spark, sf):
    return analysis.daily_analysis(assigned(spark, sf))


@register("completeness_stats", f"WITH {SOURCED}, {DAILY_ANALYSIS} SELECT symbol, round(avg(completeness), 6) AS mean, round(min(completeness), 6) AS min, round(max(completeness), 6) AS max, round(stddev_pop(completeness), 4) AS std, count(*) FILTER (WHERE completeness >= 100) AS days_100, count(*) FILTER (WHERE completeness >= 95) AS days_95, count(*) FILTER (WHERE completeness < 90) AS days_below_90 FROM c GROUP BY 1")
def _(spark, sf):
    return analysis.completeness_stats(analysis.daily_analysis(assigned(spark, sf)))


@register("hourly_extremes", f"WITH {bars_sql()}, h AS (SELECT hour(time) AS hour, 100.0::DOUBLE * count(*) / (count(DISTINCT time::DATE) * 60) AS pct FROM b GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY pct, hour) AS i, count(*) OVER () AS n FROM h) SELECT string_agg(hour::VARCHAR, ',' ORDER BY i) FILTER (WHERE i <= 3) AS lowest, string_agg(hour::VARCHAR, ',' ORDER BY i) FILTER (WHERE i > n - 3) AS highest, bool_or(hour = 9 AND pct < 90) AS opening_issues, bool_or(hour = 15 AND pct < 90) AS closing_issues, bool_or(hour IN (12, 13) AND pct < 95) AS lunch_pattern FROM r")
def _(spark, sf):
    return analysis.hourly_extremes(bars(spark, sf), 60)


@register("tracker_summary", f"WITH {SOURCED} SELECT symbol, count(*) AS total, count(*) FILTER (WHERE contains(data_origin, 'IMPUTADO')) AS imputed, round(100.0 * count(*) FILTER (WHERE contains(data_origin, 'IMPUTADO')) / count(*), 6) AS imputation_rate, count(DISTINCT time::DATE) AS days, count(DISTINCT year(time)) AS years, count(DISTINCT {LABEL}) AS sources, round(100.0 * count(*) / (count(DISTINCT CASE WHEN isodow(time) < 6 THEN time::DATE END) * 78), 6) AS completeness FROM a GROUP BY 1")
def _(spark, sf):
    return analysis.summary(assigned(spark, sf))


EVENTS_SQL = "e AS (SELECT (event_id % 90)::BIGINT AS gap_minutes, CASE WHEN event_id % 3 = 0 THEN 'brownian_bridge' WHEN event_id % 3 = 1 THEN 'not_imputed' END AS filled_by, CASE WHEN event_id % 3 = 0 THEN event_id % 7 * 0.5 END::DOUBLE AS variance FROM events)"


def gap_events(spark, sf):
    i = F.col("event_id")
    return read_table(spark, sf, "events").select((i % 90).alias("gap_minutes"), F.when(i % 3 == 0, "brownian_bridge").when(i % 3 == 1, "not_imputed").alias("filled_by"), F.when(i % 3 == 0, (i % 7) * F.lit(0.5)).alias("variance"))


@register("gap_analysis", f"WITH {EVENTS_SQL} SELECT CASE WHEN gap_minutes <= 10 THEN 'small (<=10 min)' WHEN gap_minutes <= 30 THEN 'medium (11-30 min)' WHEN gap_minutes <= 60 THEN 'large (31-60 min)' ELSE 'very large (>60 min)' END AS size, count(*) AS n, sum(gap_minutes)::BIGINT AS minutes, count(filled_by) AS filled, round(100.0 * count(filled_by) / count(*), 6) AS fill_rate, round(coalesce(sum(variance), 0), 4) AS variance, round(sum(variance) / nullif(count(filled_by), 0), 4) AS variance_per_fill FROM e GROUP BY 1")
def _(spark, sf):
    return analysis.gap_analysis(gap_events(spark, sf))


@register("fill_methods", f"WITH {EVENTS_SQL} SELECT filled_by, count(*) AS n FROM e WHERE filled_by IS NOT NULL GROUP BY 1")
def _(spark, sf):
    return analysis.fill_methods(gap_events(spark, sf))


BROKEN = "x AS (SELECT CASE WHEN seq % 11 = 0 THEN 'ROTO' WHEN seq % 13 = 0 THEN NULL ELSE data_origin END AS data_origin, CASE WHEN seq % 17 = 0 THEN 1.5 WHEN seq % 19 = 0 THEN -0.1 ELSE quality_score END AS quality_score FROM a)"
KNOWN = ", ".join(f"'{k}'" for k in DATA_ORIGINS)


def broken(spark, sf):
    s = F.col("seq")
    return assigned(spark, sf).withColumns({"data_origin": F.when(s % 11 == 0, "ROTO").when(s % 13 != 0, F.col("data_origin")), "quality_score": F.when(s % 17 == 0, 1.5).when(s % 19 == 0, -0.1).otherwise(F.col("quality_score"))})


@register("lineage_validate", f"WITH {SOURCED}, {BROKEN} SELECT count(*) AS n, count(*) FILTER (WHERE data_origin IS NULL) AS null_origin, count(*) FILTER (WHERE data_origin NOT IN ({KNOWN})) AS unknown_origin, count(*) FILTER (WHERE NOT quality_score BETWEEN 0 AND 1) AS bad_score FROM x")
def _(spark, sf):
    return lineage.validate(broken(spark, sf))


@register("origin_distribution", f"WITH {SOURCED}, {BROKEN} SELECT data_origin, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM x), 6) AS share, round(avg(quality_score), 6) AS mean, round(min(quality_score), 6) AS min, round(max(quality_score), 6) AS max, round(stddev_samp(quality_score), 4) AS std, coalesce(data_origin IN ({KNOWN}), false) AS valid FROM x GROUP BY 1")
def _(spark, sf):
    return analysis.origin_distribution(broken(spark, sf), tuple(DATA_ORIGINS))


@register("score_buckets", f"WITH {SOURCED} SELECT CASE WHEN quality_score >= 0.9 THEN 'excellent' WHEN quality_score >= 0.7 THEN 'good' WHEN quality_score >= 0.5 THEN 'fair' ELSE 'poor' END AS bucket, count(*) AS n FROM a GROUP BY 1")
def _(spark, sf):
    return assigned(spark, sf).groupBy(lineage.score_bucket().alias("bucket")).agg(F.count("*").alias("n"))


# Validators.


@register("volume_integrity", f"WITH {bars_sql()}, x AS (SELECT *, (tick_volume - avg(tick_volume) OVER (PARTITION BY symbol)) / nullif(stddev_pop(tick_volume) OVER (PARTITION BY symbol), 0) AS z FROM b) SELECT symbol, count(*) FILTER (WHERE tick_volume < 0) AS negatives, count(*) FILTER (WHERE tick_volume = 0) AS zeros, CASE WHEN count(*) > 100 THEN count(*) FILTER (WHERE abs(z) > 5) ELSE 0 END AS outliers, round(avg(spread), 6) AS spread_mean, round(min(spread), 6) AS spread_min, round(max(spread), 6) AS spread_max, count(*) FILTER (WHERE spread < 0) AS spread_negatives, count(*) FILTER (WHERE tick_volume < 0 OR spread < 0) = 0 AS passed FROM x GROUP BY 1")
def _(spark, sf):
    return quality.volume_integrity(bars(spark, sf))


@register("price_continuity", f"WITH {bars_sql()}, x AS (SELECT symbol, time, abs((open - {C1}) / nullif({C1}, 0)) AS jump, {CHG1} AS ret FROM b), y AS (SELECT *, lag(ret) OVER {W} AS ret1 FROM x) SELECT symbol, count(*) FILTER (WHERE jump > 0.02) AS over_2pct, count(*) FILTER (WHERE jump > 0.05) AS over_5pct, round(max(jump), 4) AS max_jump, round(avg(jump), 4) AS mean_jump, CASE WHEN count(ret) > 10 THEN round(corr(ret, ret1), 4) END AS autocorrelation, count(*) FILTER (WHERE jump > 0.05) = 0 AS passed FROM y GROUP BY 1")
def _(spark, sf):
    return quality.price_continuity(bars(spark, sf))


MARKET = f"h AS (SELECT symbol, count(*) FILTER (WHERE isodow(time) > 5) = 0 AND count(*) FILTER (WHERE {OUTSIDE}) = 0 AS hours_ok FROM x GROUP BY 1), i AS (SELECT *, {DIFF} AS d FROM x), r AS (SELECT symbol, count(*) FILTER (WHERE d BETWEEN 4.9 AND 5.1) >= 0.95 * count(d) AS m5_ok, count(*) FILTER (WHERE NOT contains(data_origin, 'IMPUTADO')) >= 0.8 * count(*) AS flags_ok FROM i GROUP BY 1)"


@register("market_checks", f"WITH {bars_sql()}, x AS (SELECT * FROM b WHERE symbol IN ('click', 'view') OR NOT ({OUTSIDE})), {MARKET} SELECT symbol, hours_ok, m5_ok, flags_ok, hours_ok AND m5_ok AND flags_ok AS overall FROM h JOIN r USING (symbol)")
def _(spark, sf):
    from ..operators.sessions import is_market_open

    b = bars(spark, sf)
    return analysis.market_checks(b.where(F.col("symbol").isin("click", "view") | is_market_open(holidays=False)))


RUNS = "f AS (SELECT 'ALL' AS symbol, ts AS time, event_type IN ('click', 'view') AS f FROM events), r AS (SELECT *, row_number() OVER (ORDER BY time) - row_number() OVER (PARTITION BY f ORDER BY time) AS run FROM f), l AS (SELECT max(k) AS longest_imputed FROM (SELECT count(*) AS k FROM r WHERE f GROUP BY run))"


@register("flag_checks", f"WITH {RUNS}, x AS (SELECT symbol, round(100.0 * count(*) FILTER (WHERE NOT f) / count(*), 6) AS real_pct, round(100.0 * count(*) FILTER (WHERE f) / count(*), 6) AS imputed_pct FROM f GROUP BY 1) SELECT *, real_pct >= 80 AND longest_imputed <= 50 AS passed FROM x, l")
def _(spark, sf):
    return analysis.flag_checks(flagged(spark, sf))


@register("imputation_days", "WITH d AS (SELECT 'ALL' AS symbol, ts::DATE AS date, count(*) AS n, count(*) FILTER (WHERE event_type IN ('click', 'view')) AS imputed FROM events GROUP BY 2), p AS (SELECT *, round(100.0 * imputed / n, 6) AS pct FROM d) SELECT * FROM p WHERE pct > 40")
def _(spark, sf):
    return quality.imputation_days(flagged(spark, sf), 40.0)


@register("originality", "WITH d AS (SELECT ts::DATE AS d, count(*) AS n, count(*) FILTER (WHERE event_type IN ('click', 'view')) AS k FROM events GROUP BY 1) SELECT 'ALL' AS symbol, round(100.0 * (sum(n) - sum(k)) / sum(n), 6) AS originality, count(*) FILTER (WHERE k > 0.4 * n) AS dates_over FROM d")
def _(spark, sf):
    return analysis.originality(flagged(spark, sf), 0.4)


JUMPS = f"j AS (SELECT symbol, time, abs((open - {C1}) / nullif({C1}, 0)) AS jump FROM b)"


@register("integrity_checks", f"WITH {bars_sql()}, {JUMPS} SELECT symbol, o.ok AS ohlc_ok, true AS volume_ok, c.ok AS continuity_ok, true AS flags_ok, o.ok AND c.ok AS overall FROM (SELECT symbol, count(*) FILTER (WHERE {BAD} OR least(open, high, low, close) <= 0) = 0 AS ok FROM b GROUP BY 1) AS o JOIN (SELECT symbol, count(*) FILTER (WHERE jump > 0.05) = 0 AS ok FROM j GROUP BY 1) AS c USING (symbol)")
def _(spark, sf):
    return analysis.integrity_checks(bars(spark, sf))


@register("temporal_checks", f"WITH {HOURLY}, i AS (SELECT *, {DIFF} AS d FROM b), a AS (SELECT symbol, count(*) FILTER (WHERE d BETWEEN 4.5 AND 5.5) >= 0.95 * count(d) AS interval_ok FROM i GROUP BY 1), p AS (SELECT symbol, count(*) FILTER (WHERE n = 24) AS perfect_days FROM (SELECT symbol, time::DATE AS d, count(*) AS n FROM b GROUP BY 1, 2) GROUP BY 1) SELECT symbol, interval_ok, true AS order_ok, perfect_days, interval_ok AS overall FROM a JOIN p USING (symbol)")
def _(spark, sf):
    b = bars(spark, sf, "1 hour").withColumn("seq", F.unix_timestamp(F.col("time").cast("timestamp")))
    return analysis.temporal_checks(b, 24)


@register("first_gaps", f"WITH {bars_sql()}, d AS (SELECT symbol, lag(time) OVER {W} AS gap_start, time AS gap_end, {DIFF} AS gap_minutes FROM b) SELECT * FROM d WHERE gap_minutes > 7.5 ORDER BY gap_start, symbol LIMIT 10")
def _(spark, sf):
    return analysis.first_gaps(bars(spark, sf))


@register("coverage_histograms", f"WITH {bars_sql()} SELECT symbol, 'weekday' AS kind, (isodow(time) - 1)::INTEGER AS bin, count(*) AS n FROM b GROUP BY ALL UNION ALL SELECT symbol, 'hour', hour(time)::INTEGER, count(*) FROM b GROUP BY ALL")
def _(spark, sf):
    return analysis.coverage_histograms(bars(spark, sf))


@register("capture_integrity", f"WITH {bars_sql()}, x AS (SELECT *, {DIFF} AS d FROM b), y AS (SELECT symbol, count(*) AS n, count(*) FILTER (WHERE least(open, high, low, close) < 0) AS negatives, count(*) FILTER (WHERE {BAD}) AS bad_bars, count(*) FILTER (WHERE d > 10) AS large_gaps, round(max(d) FILTER (WHERE d > 10), 6) AS largest_gap, round(avg(d) FILTER (WHERE d > 10), 6) AS mean_large_gap, count(*) FILTER (WHERE d > 60) AS extreme_gaps, count(*) - count(DISTINCT time) AS repeated_times, max(high) - min(low) > 0.5 * avg(close) AS wide_range, 0::BIGINT AS nulls, round(min(close), 6) AS close_min, round(max(close), 6) AS close_max, round(avg(close), 6) AS close_mean, round(stddev_samp(close), 4) AS close_std FROM x GROUP BY 1) SELECT *, negatives = 0 AND bad_bars = 0 AS valid FROM y")
def _(spark, sf):
    return analysis.capture_integrity(bars(spark, sf))


SPAN = "g AS (SELECT symbol, count(DISTINCT time::DATE) AS trading_days, count(*) - count(DISTINCT time) AS repeated_times, min(time::DATE) AS a, max(time::DATE) AS z FROM b GROUP BY 1), e AS (SELECT symbol, count(*) AS expected_days FROM (SELECT symbol, unnest(generate_series(a::TIMESTAMP, z::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM g) WHERE isodow(d) < 6 GROUP BY 1)"


@register("checklist_coverage", f"WITH {HOURLY}, {SPAN}, d AS (SELECT symbol, time::DATE AS d, count(*) AS n FROM b GROUP BY 1, 2), k AS (SELECT symbol, count(*) FILTER (WHERE n = 24) AS perfect, count(*) FILTER (WHERE n >= 21.6 AND n <> 24) AS good, count(*) FILTER (WHERE n >= 16.8 AND n < 21.6) AS acceptable, count(*) FILTER (WHERE n < 16.8) AS poor FROM d GROUP BY 1) SELECT symbol, trading_days, expected_days, repeated_times, round(trading_days / expected_days::DOUBLE, 6) AS coverage, perfect, good, acceptable, poor FROM g JOIN e USING (symbol) JOIN k USING (symbol)")
def _(spark, sf):
    return analysis.checklist_coverage(bars(spark, sf, "1 hour"), 24)


@register("features_by_category", "SELECT * FROM (VALUES ('price', 4), ('volume', 1), ('technical', 0), ('temporal', 0), ('session', 0), ('all', 9)) AS v(category, n_features)")
def _(spark, sf):
    return analysis.features_by_category(bars(spark, sf, "1 hour"))


@register("split_checks", f"WITH {HOURLY}, {I_SQL}, x AS (SELECT symbol, time, CASE WHEN i < floor(n * 0.8) THEN 'train' ELSE 'validation' END AS role FROM i) SELECT symbol, 0 AS split_id, count(*) FILTER (WHERE role = 'train') AS train, count(*) FILTER (WHERE role = 'validation') AS validation, round(count(*) FILTER (WHERE role = 'train') / count(*)::DOUBLE, 6) AS train_share, max(time) FILTER (WHERE role = 'train') >= min(time) FILTER (WHERE role = 'validation') AS overlap FROM x GROUP BY 1")
def _(spark, sf):
    return analysis.split_checks(clean.split_ratio(bars(spark, sf, "1 hour"), 0.8))


def checklist_sql(overlap: str) -> str:
    return f"""WITH {bars_sql()}, {SPAN}, x AS (SELECT *, {DIFF} AS d, {RET['log_return']} AS lr FROM b), k AS (SELECT symbol AS ks, stddev_samp(lr) AS sd FROM x GROUP BY 1),
a AS (SELECT symbol, count(*) AS n, count(*) - count(DISTINCT time) AS dups, count(*) FILTER (WHERE isodow(time) > 5) AS weekend, count(*) FILTER (WHERE NOT (hour(time) BETWEEN 9 AND 15 OR (hour(time) = 16 AND minute(time) = 0))) AS outside, count(*) FILTER (WHERE {BAD}) AS ohlc, count(*) FILTER (WHERE d > 5) AS gaps, 0.0::DOUBLE AS null_pct, round(100.0 * count(*) FILTER (WHERE abs(lr) > 20 * sd) / count(*), 6) AS far_pct FROM x JOIN k ON symbol = ks GROUP BY 1),
s AS (SELECT a.*, {overlap} AS overlap, round(greatest(0, 100.0 - (dups > 0)::INT * 10 - (weekend > 0)::INT * 15 - (outside > 0)::INT * 10 - (null_pct > 5)::INT * 10 - (ohlc > 0)::INT * 20 - (gaps > 100)::INT * 5 - (far_pct > 1)::INT * 5 - ({overlap})::INT * 15 - greatest(0, (0.8 - trading_days / expected_days::DOUBLE) * 50)), 4) AS score FROM a JOIN g USING (symbol) JOIN e USING (symbol))
SELECT *, CASE WHEN score >= 90 THEN 'EXCELLENT' WHEN score >= 80 THEN 'GOOD' WHEN score >= 70 THEN 'ACCEPTABLE' WHEN score >= 60 THEN 'POOR' ELSE 'FAILED' END AS status FROM s"""


@register("checklist_score", checklist_sql("false"))
def _(spark, sf):
    return quality.checklist_score(bars(spark, sf))


@register("checklist_score_overlap", checklist_sql("symbol <> 'click'"))
def _(spark, sf):
    b = bars(spark, sf)
    role = F.when(F.minute("time") % 2 == 0, "train").otherwise("validation")
    split = b.select("symbol", "time", F.when(F.col("symbol") == "click", "train").otherwise(role).alias("role"))
    return quality.checklist_score(b, split)


@register("return_moments", f"WITH {HOURLY}, x AS (SELECT symbol, {RET['log_return']} AS lr FROM b), k AS (SELECT symbol AS ks, stddev_samp(lr) AS sd FROM x GROUP BY 1) SELECT symbol, round(avg(lr), 4) AS mean, round(stddev_samp(lr), 4) AS std, round(skewness(lr), 4) AS skew, round(kurtosis(lr), 4) AS kurt, round(100.0 * count(*) FILTER (WHERE abs(lr) > 20 * sd) / count(*), 6) AS far_pct FROM x JOIN k ON symbol = ks GROUP BY 1")
def _(spark, sf):
    return quality.moments(features.add(bars(spark, sf, "1 hour"), features.returns()), "log_return")


FAR = " + ".join(f"coalesce((abs({c} - m_{c}) > 5 * s_{c} AND s_{c} > 0)::INT, 0)" for c in NUMERIC)
CHECKS = f"""t AS (SELECT * FROM b UNION ALL SELECT * FROM b WHERE hour(time) = 3), k AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}' for c in NUMERIC)} FROM t), q AS (SELECT sum({FAR})::BIGINT AS far, date_diff('day', min(time)::DATE, max(time)::DATE) AS days, count(*) AS n, count(*) FILTER (WHERE {BAD}) AS bad, count(*) - (SELECT count(*) FROM b) AS again FROM t, k),
c(name, v, ok, worse) AS (SELECT unnest([{{'a': 'no_duplicates', 'v': again, 'ok': again = 0, 'w': 'FAIL'}}, {{'a': 'no_missing_values', 'v': 0, 'ok': true, 'w': 'WARN'}}, {{'a': 'numeric_columns', 'v': 7, 'ok': false, 'w': 'WARN'}}, {{'a': 'temporal_coverage', 'v': days, 'ok': days > 30, 'w': 'WARN'}}, {{'a': 'no_zero_variance', 'v': 1, 'ok': false, 'w': 'WARN'}}, {{'a': 'essential_features', 'v': 1, 'ok': false, 'w': 'FAIL'}}, {{'a': 'extreme_outliers', 'v': far, 'ok': far < 0.01 * n, 'w': 'WARN'}}, {{'a': 'ohlcv_integrity', 'v': bad, 'ok': bad = 0, 'w': 'FAIL'}}, {{'a': 'non_negative_volume', 'v': 0, 'ok': true, 'w': 'FAIL'}}], recursive := true) FROM q), r AS (SELECT name AS "check", v::BIGINT AS value, CASE WHEN ok THEN 'PASS' ELSE worse END AS status FROM c)"""


@register("reporter_checks", f"WITH {HOURLY}, {CHECKS} SELECT * FROM r")
def _(spark, sf):
    return analysis.reporter_checks(repeated_bars(spark, sf))


@register("reporter_score", f"WITH {HOURLY}, {CHECKS}, i AS (SELECT 100.0::DOUBLE * count(*) FILTER (WHERE status = 'PASS') / count(*) AS x FROM r), s AS (SELECT x, 0.5 * 97 + 0.3 * x + 0.2 * 88 AS y FROM i) SELECT round(x, 4) AS integrity, round(y, 4) AS score, CASE WHEN y >= 95 THEN 'A+' WHEN y >= 90 THEN 'A' WHEN y >= 85 THEN 'B+' WHEN y >= 80 THEN 'B' WHEN y >= 75 THEN 'C+' WHEN y >= 70 THEN 'C' WHEN y >= 60 THEN 'D' ELSE 'F' END AS grade FROM s")
def _(spark, sf):
    return analysis.reporter_score(analysis.reporter_checks(repeated_bars(spark, sf)), F.lit(97.0), F.lit(88.0))


@register("recommendations", f"WITH {HOURLY}, {CHECKS} SELECT \"check\", CASE WHEN status = 'FAIL' THEN 'HIGH' ELSE 'MEDIUM' END AS priority FROM r WHERE status <> 'PASS'")
def _(spark, sf):
    return analysis.recommendations(analysis.reporter_checks(repeated_bars(spark, sf))).drop("advice")


@register("large_gap_labels", f"WITH {bars_sql()}, {GAPS_SQL} SELECT symbol, gap_start, gap_end, CASE WHEN gap_minutes > 60 THEN 'unresolved' ELSE 'ok' END AS status FROM g")
def _(spark, sf):
    return gaps.label_large_gaps(gaps.detect_gaps(bars(spark, sf))).select("symbol", "gap_start", "gap_end", "status")


@register("price_relative", f"WITH {HOURLY} SELECT symbol, time, round(CASE WHEN count(close) OVER r >= 10 THEN open / nullif(avg(close) OVER r, 0) END, 6) AS open FROM b WINDOW r AS (PARTITION BY symbol ORDER BY time ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)")
def _(spark, sf):
    b = bars(spark, sf, "1 hour")
    return rounded(b.withColumn("open", clean.relative_price(b, "open")), ["open"])


# All features: the SQL of every part, joined.
PARTS = ["returns", "candle_shape", "sma_family", "bollinger", "atr", "stochastic", "volatility", "parkinson", "volume_features", "vwap", "cyclic_features", "rolling_stats", "cumulative_returns", "calendar_features", "session_features", "structure_patterns", "ema_family", "macd"]
DIGITS = {name: digits for part in PARTS for name, digits in featured_digits(part).items()} | {f"rsi_{n}": 4 for n in (14, 21, 28)} | {x: 4 for n in SPANS for x in (f"ema_{n}", f"ema_{n}_slope")} | {"macd": 4, "macd_signal": 4, "macd_histogram": 4}


def rsi_sql(n: int) -> str:
    return f"WITH RECURSIVE {HOURLY}, m AS (SELECT *, row_number() OVER {W} AS rn, coalesce(close - {C1}, 0) AS d FROM b), n AS (SELECT *, greatest(d, 0) AS g, greatest(-d, 0) AS l FROM m), r AS (SELECT symbol, {n + 1}::BIGINT AS rn, sum(g) / {n} AS g, sum(l) / {n} AS l FROM n WHERE rn <= {n + 1} GROUP BY 1 HAVING count(*) = {n + 1} UNION ALL SELECT n.symbol, n.rn, (r.g * {n - 1} + n.g) / {n}, (r.l * {n - 1} + n.l) / {n} FROM r JOIN n ON n.symbol = r.symbol AND n.rn = r.rn + 1) SELECT n.symbol, n.time, round(CASE WHEN n.rn <= {n} THEN NULL WHEN r.l = 0 THEN 100 ELSE 100 - 100 / (1 + r.g / r.l) END, 4) AS rsi_{n} FROM n LEFT JOIN r ON n.symbol = r.symbol AND n.rn = r.rn"


@register("all_features", "SELECT * FROM " + " JOIN ".join(f"({q}) AS q{i}" + (" USING (symbol, time)" if i else "") for i, q in enumerate([*[SQL[p] for p in PARTS], *[rsi_sql(n) for n in (14, 21, 28)]])))
def _(spark, sf):
    t = features.all_features(bars(spark, sf, "1 hour"))
    base = ("open", "high", "low", "close", "tick_volume", "real_volume", "spread", "data_origin")
    return t.select("symbol", "time", *[F.round(c, DIGITS[c]).alias(c) if c in DIGITS else F.col(c) for c in t.columns if c not in (*base, "symbol", "time")])


@register("market_calendar", "WITH c(date, expected) AS (VALUES " + ", ".join(f"(DATE '{d}', 0)" for d in holiday_list(2020, 2030)) + "), y AS (SELECT unnest(generate_series(TIMESTAMP '2020-01-01', TIMESTAMP '2030-12-31', INTERVAL 1 DAY))::DATE AS date) SELECT y.date, c.date IS NOT NULL AS is_holiday FROM y LEFT JOIN c ON y.date = c.date")
def _(spark, sf):
    return calendar_table(spark, 2020, 2030).select("date", "is_holiday")
