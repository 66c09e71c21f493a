"""Registered queries of the market-data operators over the driver's tables, each with its SQL.

Ticks: events (time ts, price value, symbol event_type); bars: those ticks in 5-minute or hourly bins; daily bars:
lineitem by ship date.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import holiday_list
from ..functions.catalog import DATA_ORIGINS
from ..operators import clean, features, gaps, lineage, quality, recurrence, resample, sessions
from ..sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def bars(spark: SparkSession, sf: str, width: str = "5 minutes") -> DataFrame:
    return resample.ticks_to_bars(resample.ticks_of_events(read_table(spark, sf, "events")), width)


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return resample.ticks_to_bars(resample.daily_ticks_of_lineitem(read_table(spark, sf, "lineitem")), "1 day")


def bars_sql(width: str = "5 minutes", name: str = "b") -> str:
    return f"""{name} AS (SELECT event_type AS symbol, time_bucket(INTERVAL '{width}', ts) AS time, arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
 arg_max(value, ts) AS close, count(*) AS tick_volume, count(*)::BIGINT AS real_volume, 0.0::DOUBLE AS spread, 'M5_AGREGADO_TICKS' AS data_origin FROM events GROUP BY 1, 2)"""


DAILY_SQL = """b AS (SELECT 'LI' AS symbol, time_bucket(INTERVAL '1 day', l_shipdate) AS time, arg_min(l_extendedprice, struct_pack(a := l_shipdate, b := l_orderkey * 10 + l_linenumber)) AS open,
 max(l_extendedprice) AS high, min(l_extendedprice) AS low, arg_max(l_extendedprice, struct_pack(a := l_shipdate, b := l_orderkey * 10 + l_linenumber)) AS close, count(*) AS tick_volume,
 sum(l_quantity::BIGINT)::BIGINT AS real_volume FROM lineitem GROUP BY 2)"""
BARS = "symbol, time, open, high, low, close, tick_volume, real_volume"
W = "(PARTITION BY symbol ORDER BY time)"


def R(n: int) -> str:
    return f"(PARTITION BY symbol ORDER BY time ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def full_sql(agg: str, col: str, n: int) -> str:
    return f"CASE WHEN count({col}) OVER {R(n)} = {n} THEN {agg}({col}) OVER {R(n)} END"


def rounded(df: DataFrame, cols: list[str], n: int = 6) -> DataFrame:
    return df.select("symbol", "time", *[F.round(c, n).alias(c) for c in cols])


def rounds(cols: list[str], n: int = 6) -> str:
    return ", ".join(f"round({c}, {n}) AS {c}" for c in cols)


DIGITS: dict[str, dict[str, int]] = {}


def featured_digits(name: str) -> dict[str, int]:
    """The decimals that a feature query's columns are rounded to."""
    return DIGITS.get(name, {})


def featured(name: str, groups: Callable[[], list], exprs: dict[str, str], inner: str = "b", digits: int = 6) -> None:
    """A feature query over hourly bars: the operator's columns, and their SQL over `inner`."""
    cols = list(exprs)
    DIGITS[name] = dict.fromkeys(cols, digits)

    @register(name, f"WITH {bars_sql('1 hour')}, x AS (SELECT symbol, time, {', '.join(f'{e} AS {c}' for c, e in exprs.items())} FROM {inner}) SELECT symbol, time, {rounds(cols, digits)} FROM x")
    def run(spark, sf):
        return rounded(features.add(bars(spark, sf, "1 hour"), *groups()), cols, digits)


# Resampling.


@register("ticks_to_ohlc_5m", f"WITH {bars_sql()} SELECT {BARS} FROM b")
def _(spark, sf):
    return bars(spark, sf).select(*BARS.split(", "))


@register("ticks_to_ohlc_1h", f"WITH {bars_sql('1 hour')} SELECT {BARS} FROM b")
def _(spark, sf):
    return bars(spark, sf, "1 hour").select(*BARS.split(", "))


@register("resample_h1_to_d1", f"WITH {bars_sql('1 hour')} SELECT symbol, time_bucket(INTERVAL '1 day', time) AS time, arg_min(open, time) AS open, max(high) AS high, min(low) AS low, arg_max(close, time) AS close, sum(tick_volume)::BIGINT AS tick_volume, sum(real_volume)::BIGINT AS real_volume FROM b GROUP BY 1, 2")
def _(spark, sf):
    return resample.resample_bars(bars(spark, sf, "1 hour"), "1 day").select(*BARS.split(", "))


@register("daily_bars", f"WITH {DAILY_SQL} SELECT {BARS} FROM b")
def _(spark, sf):
    return daily(spark, sf).select(*BARS.split(", "))


PRIO_SQL = """u AS (SELECT o_orderdate AS time, o_totalprice AS close, 'M5' AS source_timeframe, 1.0::DOUBLE AS q, o_orderkey AS seq FROM orders UNION ALL SELECT l_shipdate, l_extendedprice, 'M10', 0.85::DOUBLE, l_orderkey * 10 + l_linenumber FROM lineitem)"""


def two_sources(spark, sf):
    o = read_table(spark, sf, "orders").select(F.lit("X").alias("symbol"), F.col("o_orderdate").alias("time"), F.col("o_totalprice").alias("close"), F.lit("M5").alias("source_timeframe"), F.col("o_orderkey").alias("seq"))
    li = read_table(spark, sf, "lineitem").select(F.lit("X").alias("symbol"), F.col("l_shipdate").alias("time"), F.col("l_extendedprice").alias("close"), F.lit("M10").alias("source_timeframe"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))
    return resample.union_sources(o, li)


@register("prioritize_sources", f"WITH {PRIO_SQL} SELECT time, close, source_timeframe, q AS quality_score FROM u QUALIFY row_number() OVER (PARTITION BY time ORDER BY q DESC, seq) = 1")
def _(spark, sf):
    return resample.prioritize(two_sources(spark, sf), ("seq",)).select("time", "close", "source_timeframe", "quality_score")


@register("dedupe_keep_last", f"WITH {PRIO_SQL} SELECT time, close, seq FROM u QUALIFY row_number() OVER (PARTITION BY time ORDER BY seq DESC, source_timeframe DESC) = 1")
def _(spark, sf):
    t = two_sources(spark, sf).withColumn("o", F.struct("seq", "source_timeframe"))
    return resample.dedupe(t, "last", order="o").select("time", "close", "seq")


@register("duplicates_report", "SELECT l_shipdate AS time, count(*) AS n_rows FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def _(spark, sf):
    t = read_table(spark, sf, "lineitem").select(F.col("l_shipdate").alias("time"))
    return resample.duplicates_report(t, ("time",))


# Sessions.
HOLIDAYS = ", ".join(f"DATE '{d}'" for d in holiday_list())
NY = "timezone('America/New_York', timezone('UTC', time))"
SOD = f"(hour({NY}) * 3600 + minute({NY}) * 60 + second({NY}))"
OPEN = f"(isodow({NY}) < 6 AND {SOD} BETWEEN 34200 AND 57600 AND {NY}::DATE NOT IN ({HOLIDAYS}))"


@register("market_hours_filter", f"WITH {bars_sql()} SELECT symbol, time, close FROM b WHERE {OPEN}")
def _(spark, sf):
    return sessions.filter_market_hours(bars(spark, sf)).select("symbol", "time", "close")


@register("market_hours_stats", f"WITH {bars_sql()} SELECT symbol, count(*) AS total, count(*) FILTER (WHERE {OPEN}) AS kept, count(*) - count(*) FILTER (WHERE {OPEN}) AS removed, round(100.0 * count(*) FILTER (WHERE {OPEN}) / count(*), 6) AS pct_kept FROM b GROUP BY 1")
def _(spark, sf):
    return sessions.market_hours_stats(bars(spark, sf))


@register("forex_open_filter", f"WITH {bars_sql()} SELECT symbol, time, close FROM b WHERE NOT ((isodow(time) = 5 AND hour(time) >= 22) OR isodow(time) = 6 OR (isodow(time) = 7 AND hour(time) < 22))")
def _(spark, sf):
    return sessions.filter_market_hours(bars(spark, sf), "FX").select("symbol", "time", "close")


@register("hourly_distribution", f"WITH {bars_sql()} SELECT symbol, hour({NY})::INTEGER AS hour, (isodow({NY}) - 1)::INTEGER AS weekday, count(*) AS n FROM b GROUP BY 1, 2, 3")
def _(spark, sf):
    return sessions.time_distribution(bars(spark, sf))


DIFF = f"date_diff('microsecond', lag(time) OVER {W}, time) / 60e6"


@register("interval_stats", f"WITH {bars_sql()}, d AS (SELECT symbol, {DIFF} AS d FROM b) SELECT symbol, round(avg(d), 6) AS mean_min, round(quantile_cont(d, 0.5), 6) AS median_min, round(min(d), 6) AS min_min, round(max(d), 6) AS max_min, round(stddev_samp(d), 6) AS std_min, count(*) FILTER (WHERE abs(d - 5) > 1) AS irregular, avg(d) > 7.5 AS too_sparse, count(*) FILTER (WHERE abs(d - 5) > 1) > 0.1 * count(d) AS too_irregular FROM d GROUP BY 1")
def _(spark, sf):
    return sessions.interval_stats(bars(spark, sf))


# Gaps.


def inside(c: str) -> str:
    t = f"timezone('America/New_York', timezone('UTC', {c}))"
    return f"(isodow({t}) < 6 AND hour({t}) + minute({t}) / 60.0 BETWEEN 9.5 AND 16.0)"


GAPS_SQL = f"""g0 AS (SELECT symbol, lag(time) OVER {W} AS gap_start, time AS gap_end FROM b), g1 AS (SELECT *, date_diff('microsecond', gap_start, gap_end) / 60e6 AS m FROM g0),
g AS (SELECT symbol, gap_start, gap_end, floor(m)::BIGINT AS gap_minutes, {inside('gap_start')} AND {inside('gap_end')} AS market_hours FROM g1 WHERE m > 7)"""


@register("gaps_classified", f"WITH {bars_sql()}, {GAPS_SQL} SELECT *, CASE WHEN NOT market_hours THEN 'ignored' WHEN gap_minutes <= 30 THEN 'imputable' ELSE 'not_imputable' END AS gap_type, CASE WHEN NOT market_hours THEN 'fuera_de_horario' WHEN gap_minutes <= 30 THEN 'gap_corto' ELSE 'gap_largo' END AS reason FROM g")
def _(spark, sf):
    return gaps.detect_gaps(bars(spark, sf))


@register("gap_buckets", f"WITH {bars_sql()}, {GAPS_SQL} SELECT symbol, CASE WHEN gap_minutes <= 15 THEN '5-15' WHEN gap_minutes <= 30 THEN '15-30' WHEN gap_minutes <= 60 THEN '30-60' ELSE '>60' END AS bucket, count(*) AS n, sum(gap_minutes)::BIGINT AS total_minutes, sum(gap_minutes // 5)::BIGINT AS bars_missing FROM g GROUP BY 1, 2")
def _(spark, sf):
    return gaps.gap_buckets(gaps.detect_gaps(bars(spark, sf)))


@register("gap_slots_missing", f"WITH {bars_sql('1 hour')}, s AS (SELECT symbol, min(time::DATE) AS a, max(time::DATE) AS z FROM b GROUP BY 1), e AS (SELECT symbol, unnest(generate_series(a::TIMESTAMP, z::TIMESTAMP + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS time FROM s) SELECT symbol, time FROM e ANTI JOIN b USING (symbol, time)")
def _(spark, sf):
    return gaps.missing_slots(bars(spark, sf, "1 hour"))


@register("daily_coverage_grade", f"WITH {bars_sql('1 hour')}, s AS (SELECT symbol, min(time::DATE) AS a, max(time::DATE) AS z FROM b GROUP BY 1), e AS (SELECT symbol, unnest(generate_series(a::TIMESTAMP, z::TIMESTAMP, INTERVAL 1 DAY))::DATE AS date FROM s), n AS (SELECT symbol, time::DATE AS date, count(*) AS n FROM b GROUP BY 1, 2), c AS (SELECT symbol, date, 24 AS expected, coalesce(n, 0)::BIGINT AS actual, round(100.0 * coalesce(n, 0) / 24, 6) AS coverage FROM e LEFT JOIN n USING (symbol, date)) SELECT *, CASE WHEN coverage >= 95 THEN 'A' WHEN coverage >= 90 THEN 'B' WHEN coverage >= 80 THEN 'C' ELSE 'D' END AS grade FROM c")
def _(spark, sf):
    return gaps.daily_coverage(bars(spark, sf, "1 hour"), 24)


@register("linear_gap_fill", f"""WITH {bars_sql()}, p AS (SELECT symbol, time, open, high, low, close, lag(time) OVER {W} AS pt, lag(open) OVER {W} AS po, lag(high) OVER {W} AS ph, lag(low) OVER {W} AS pl, lag(close) OVER {W} AS pc FROM b),
q AS (SELECT *, date_diff('minute', pt, time) // 5 - 1 AS n FROM p WHERE date_diff('minute', pt, time) > 5 AND date_diff('minute', pt, time) <= 30), s AS (SELECT *, unnest(range(1, n + 1)) AS i FROM q),
v AS (SELECT symbol, pt + INTERVAL 5 MINUTE * i AS time, po + i / (n + 1.0) * (open - po) AS o, ph + i / (n + 1.0) * (high - ph) AS h, pl + i / (n + 1.0) * (low - pl) AS l, pc + i / (n + 1.0) * (close - pc) AS c FROM s)
SELECT symbol, time, round(o, 6) AS open, round(greatest(o, h, l, c), 6) AS high, round(least(o, h, l, c), 6) AS low, round(c, 6) AS close FROM v""")
def _(spark, sf):
    return rounded(gaps.bridge_fill(bars(spark, sf), market=None), ["open", "high", "low", "close"])


@register("brownian_fill")
def _(spark, sf):
    return gaps.bridge_fill(bars(spark, sf), market=None, noise=0.001)


FLAGGED = "CASE WHEN event_type IN ('click', 'view') THEN 'M5_IMPUTADO_BROWNIAN' ELSE 'M5_NATIVO' END"


def flagged(spark, sf):
    e = read_table(spark, sf, "events")
    origin = F.when(F.col("event_type").isin("click", "view"), "M5_IMPUTADO_BROWNIAN").otherwise("M5_NATIVO")
    return e.select(F.lit("ALL").alias("symbol"), F.col("ts").alias("time"), origin.alias("data_origin"))


@register("synthetic_streaks", f"WITH f AS (SELECT ts, {FLAGGED} LIKE '%IMPUTADO%' AS f FROM events), r AS (SELECT *, row_number() OVER (ORDER BY ts) - row_number() OVER (PARTITION BY f ORDER BY ts) AS run FROM f) SELECT 'ALL' AS symbol, min(ts) AS streak_start, max(ts) AS streak_end, count(*) AS length FROM r WHERE f GROUP BY run HAVING count(*) >= 3")
def _(spark, sf):
    return gaps.synthetic_streaks(flagged(spark, sf))


# Features.
C1 = f"lag(close) OVER {W}"
RET = {"returns": f"CASE WHEN {C1} IS NULL OR {C1} = 0 THEN 0 ELSE (close - {C1}) / {C1} END", "log_return": f"CASE WHEN {C1} IS NULL OR {C1} <= 0 OR close <= 0 THEN 0 ELSE ln(close / {C1}) END", "price_change": f"close - {C1}"}
featured("returns", lambda: [features.returns()], RET)
featured("candle_shape", lambda: [features.candle_shape()], {"high_low_range": "high - low", "high_low_pct": "(high - low) / nullif(close, 0) * 100", "body": "close - open", "body_pct": "(close - open) / nullif(close, 0) * 100", "upper_shadow": "greatest(open, close) - high", "lower_shadow": "low - least(open, close)"})
SMA = ", ".join(f"avg(close) OVER {R(n)} AS sma_{n}" for n in (20, 50, 100, 200))
featured("sma_family", lambda: [features.sma_family(), features.sma_slopes()], {**{f"sma_{n}": f"sma_{n}" for n in (20, 50, 100, 200)}, **{f"sma_{n}_slope": f"sma_{n} - lag(sma_{n}) OVER {W}" for n in (20, 50, 100, 200)}}, f"(SELECT *, {SMA} FROM b)", 10)
BB = {}
for _n in (20, 30):
    for _k in (2, 3):
        mid, std = full_sql("avg", "close", _n), full_sql("stddev_samp", "close", _n)
        up, low = f"(({mid}) + {_k} * ({std}))", f"(({mid}) - {_k} * ({std}))"
        BB |= {f"bb_upper_{_n}_{_k}": up, f"bb_lower_{_n}_{_k}": low, f"bb_width_{_n}_{_k}": f"{up} - {low}", f"bb_position_{_n}_{_k}": f"(close - {low}) / nullif({up} - {low}, 0)"}
featured("bollinger", lambda: [features.bollinger()], BB)
ATR_PARTS = f"greatest(high - low, abs(high - {C1}), abs(low - {C1}))"
TR = f"(SELECT *, {ATR_PARTS} AS tr FROM b)"
featured("atr", lambda: features.atr(), {f"atr_{n}": full_sql("avg", "tr", n) for n in (14, 21)}, TR)
K = {n: f"100 * (close - ({full_sql('min', 'low', n)})) / nullif(({full_sql('max', 'high', n)}) - ({full_sql('min', 'low', n)}), 0)" for n in (14, 21)}
featured("stochastic", lambda: features.stochastic(), {**{f"stoch_k_{n}": f"k{n}" for n in K}, **{f"stoch_d_{n}": full_sql("avg", f"k{n}", 3) for n in K}}, f"(SELECT *, {', '.join(f'{e} AS k{n}' for n, e in K.items())} FROM b)")
featured("volatility", lambda: [features.returns(), features.volatility()], {f"volatility_{n}": f"({full_sql('stddev_samp', 'lr', n)}) * sqrt(252 * 78)" for n in (10, 20, 30)}, f"(SELECT *, {RET['log_return']} AS lr FROM b)", 4)
featured("parkinson", lambda: features.parkinson(), {"parkinson_vol": f"sqrt(({full_sql('avg', 'hl', 20)}) / (4 * ln(2))) * sqrt(252 * 78)"}, "(SELECT *, CASE WHEN low <> 0 AND high / low > 0 THEN pow(ln(high / low), 2) END AS hl FROM b)", 4)
featured("volume_features", lambda: [features.volume_features()], {"volume_sma_20": full_sql("avg", "tick_volume", 20), "volume_ratio": f"tick_volume / nullif({full_sql('avg', 'tick_volume', 20)}, 0)", "volume_change": f"(tick_volume - lag(tick_volume) OVER {W}) / nullif(lag(tick_volume) OVER {W}, 0)"})
featured("vwap", lambda: features.vwap(), {"vwap": f"({full_sql('sum', 'cv', 20)}) / nullif({full_sql('sum', 'tick_volume', 20)}, 0)", "price_to_vwap": f"close / nullif(({full_sql('sum', 'cv', 20)}) / nullif({full_sql('sum', 'tick_volume', 20)}, 0), 0)"}, "(SELECT *, close * tick_volume AS cv FROM b)", 10)
featured("cyclic_features", lambda: [features.cyclic_features()], {f"{k}_{f}": f"{f}(2 * pi() * {x} / {n})" for k, x, n in (("hour", "hour(time)", 24), ("minute", "minute(time)", 60), ("dow", "(isodow(time) - 1)", 7)) for f in ("sin", "cos")})
featured("rsi_sma", lambda: features.rsi_sma(), {"rsi_sma_14": f"CASE WHEN ({full_sql('avg', 'dn', 14)}) = 0 THEN 100 ELSE 100 - 100 / (1 + ({full_sql('avg', 'up', 14)}) / nullif({full_sql('avg', 'dn', 14)}, 0)) END"}, f"(SELECT *, CASE WHEN d IS NOT NULL THEN greatest(d, 0) END AS up, CASE WHEN d IS NOT NULL THEN greatest(-d, 0) END AS dn FROM (SELECT *, close - {C1} AS d FROM b))", 4)
featured("rolling_stats", lambda: [features.rolling_stats()], {k: v for n in (20, 50) for k, v in {f"rolling_mean_{n}": f"avg(close) OVER {R(n)}", f"rolling_std_{n}": f"stddev_pop(close) OVER {R(n)}", f"rolling_min_{n}": f"min(close) OVER {R(n)}", f"rolling_max_{n}": f"max(close) OVER {R(n)}", f"rolling_range_{n}": f"max(close) OVER {R(n)} - min(close) OVER {R(n)}"}.items()}, digits=7)
CUM = "sum(ret) OVER (PARTITION BY symbol, {} ORDER BY time ROWS UNBOUNDED PRECEDING)"
featured("cumulative_returns", lambda: [features.returns(), features.cumulative_returns()], {"cumulative_return_day": CUM.format("time::DATE"), "cumulative_return_week": CUM.format("year(time), weekofyear(time)")}, f"(SELECT *, {RET['returns']} AS ret FROM b)", 4)


def whole(name: str, cols: Callable[[], dict], exprs: dict[str, str]) -> None:
    @register(name, f"WITH {bars_sql('1 hour')} SELECT symbol, time, {', '.join(f'{e} AS {c}' for c, e in exprs.items())} FROM b")
    def run(spark, sf):
        return features.add(bars(spark, sf, "1 hour"), cols()).select("symbol", "time", *exprs)


INT = lambda e: f"({e})::INTEGER"
whole("calendar_features", features.calendar_features, {"hour": INT("hour(time)"), "minute": INT("minute(time)"), "day_of_week": INT("isodow(time) - 1"), "day_of_month": INT("day(time)"), "month": INT("month(time)"), "quarter": INT("quarter(time)")})
SINCE, TO = "((hour(time) - 9) * 60 + minute(time) - 30)", "((16 - hour(time)) * 60 - minute(time))"
whole("session_features", features.session_features, {"minutes_since_open": INT(SINCE), "minutes_to_close": INT(TO), "session_progress": f"{SINCE} / 390.0::DOUBLE", "is_first_hour": INT(f"{SINCE} <= 60"), "is_last_hour": INT(f"{TO} <= 60"), "is_lunch_time": INT("hour(time) >= 12 AND hour(time) < 14"), "is_morning": INT("hour(time) < 12"), "is_afternoon": INT("hour(time) >= 12")})
P = {c: f"lag({c}) OVER {W}" for c in ("open", "high", "low", "close")}
FLAG = lambda e: f"coalesce({e}, false)::INTEGER"
whole("structure_patterns", features.structure_patterns, {
    "higher_high": FLAG(f"high > {P['high']}"), "lower_low": FLAG(f"low < {P['low']}"), "higher_low": FLAG(f"low > {P['low']}"), "lower_high": FLAG(f"high < {P['high']}"), "doji": FLAG("abs((close - open) / nullif(close, 0) * 100) < 0.1"),
    "bullish_engulfing": FLAG(f"close > open AND {P['close']} < {P['open']} AND open < {P['close']} AND close > {P['open']}"), "bearish_engulfing": FLAG(f"close < open AND {P['close']} > {P['open']} AND open > {P['close']} AND close < {P['open']}"),
})

NUMBERED = f"n AS (SELECT *, row_number() OVER {W} AS rn FROM b)"


def ema_sql(spans) -> str:
    start = ", ".join(f"close AS e{n}" for n in spans)
    step = ", ".join(f"n.close * (2.0 / {n + 1}) + r.e{n} * (1 - 2.0 / {n + 1})" for n in spans)
    return f"r AS (SELECT symbol, time, rn, {start} FROM n WHERE rn = 1 UNION ALL SELECT n.symbol, n.time, n.rn, {step} FROM r JOIN n ON n.symbol = r.symbol AND n.rn = r.rn + 1)"


SPANS = (9, 21, 55, 100, 200)


@register("ema_family", f"WITH RECURSIVE {bars_sql('1 hour')}, {NUMBERED}, {ema_sql(SPANS)}, x AS (SELECT symbol, time, {', '.join(f'e{n} AS ema_{n}, e{n} - lag(e{n}) OVER {W} AS ema_{n}_slope' for n in SPANS)} FROM r) SELECT symbol, time, {rounds([f'ema_{n}' for n in SPANS] + [f'ema_{n}_slope' for n in SPANS], 4)} FROM x")
def _(spark, sf):
    return rounded(recurrence.ema_family(bars(spark, sf, "1 hour")), [f"ema_{n}" for n in SPANS] + [f"ema_{n}_slope" for n in SPANS], 4)


@register("macd", f"WITH RECURSIVE {bars_sql('1 hour')}, {NUMBERED}, r AS (SELECT symbol, time, rn, close AS a, close AS z, 0.0::DOUBLE AS s FROM n WHERE rn = 1 UNION ALL SELECT n.symbol, n.time, n.rn, n.close * (2.0 / 13) + r.a * (11.0 / 13), n.close * (2.0 / 27) + r.z * (25.0 / 27), ((n.close * (2.0 / 13) + r.a * (11.0 / 13)) - (n.close * (2.0 / 27) + r.z * (25.0 / 27))) * 0.2 + r.s * 0.8 FROM r JOIN n ON n.symbol = r.symbol AND n.rn = r.rn + 1) SELECT symbol, time, round(a - z, 4) AS macd, round(s, 4) AS macd_signal, round(a - z - s, 4) AS macd_histogram FROM r")
def _(spark, sf):
    return rounded(recurrence.macd(bars(spark, sf, "1 hour")), ["macd", "macd_signal", "macd_histogram"], 4)


@register("rsi_wilder", f"WITH RECURSIVE {bars_sql('1 hour')}, m AS (SELECT *, row_number() OVER {W} AS rn, coalesce(close - {C1}, 0) AS d FROM b), n AS (SELECT *, greatest(d, 0) AS g, greatest(-d, 0) AS l FROM m), r AS (SELECT symbol, 15::BIGINT AS rn, sum(g) / 14 AS g, sum(l) / 14 AS l FROM n WHERE rn <= 15 GROUP BY 1 HAVING count(*) = 15 UNION ALL SELECT n.symbol, n.rn, (r.g * 13 + n.g) / 14, (r.l * 13 + n.l) / 14 FROM r JOIN n ON n.symbol = r.symbol AND n.rn = r.rn + 1) SELECT n.symbol, n.time, round(CASE WHEN n.rn <= 14 THEN NULL WHEN r.l = 0 THEN 100 ELSE 100 - 100 / (1 + r.g / r.l) END, 4) AS rsi_14 FROM n LEFT JOIN r ON n.symbol = r.symbol AND n.rn = r.rn")
def _(spark, sf):
    return rounded(recurrence.rsi_wilder(bars(spark, sf, "1 hour")), ["rsi_14"], 4)


# Analysis and quality.
CHG = "(close - lag(close) OVER (PARTITION BY symbol, {0} ORDER BY time)) / nullif(lag(close) OVER (PARTITION BY symbol, {0} ORDER BY time), 0)"


def period_sql(name: str, expr: str) -> str:
    return f"WITH {DAILY_SQL}, y AS (SELECT *, {expr} AS {name} FROM b), x AS (SELECT *, {CHG.format(name)} AS chg FROM y) SELECT symbol, {name}, count(*) AS n, count(DISTINCT time::DATE) AS days, round(max(high), 6) AS high, round(min(low), 6) AS low, round(avg(close), 6) AS close_mean, round(stddev_samp(close), 6) AS close_std, sum(tick_volume)::BIGINT AS volume, round(stddev_samp(chg), 4) AS volatility, round(stddev_samp(close) / avg(close), 6) AS cv FROM x GROUP BY 1, 2"


@register("yearly_stats", period_sql("year", "year(time)::INTEGER"))
def _(spark, sf):
    return quality.period_stats(daily(spark, sf), "year")


@register("monthly_stats", period_sql("month", "strftime(time, '%Y-%m')"))
def _(spark, sf):
    return quality.period_stats(daily(spark, sf), "month")


CHG1 = f"(close - {C1}) / nullif({C1}, 0)"


@register("volatility_report", f"WITH {DAILY_SQL}, x AS (SELECT symbol, {CHG1} AS r FROM b) SELECT symbol, round(stddev_samp(r), 4) AS std, round(stddev_samp(r) * sqrt(252 * 78), 3) AS annualized, round(max(r), 4) AS best, round(min(r), 4) AS worst, count(*) FILTER (WHERE abs(r) > 0.02) AS n_big FROM x GROUP BY 1")
def _(spark, sf):
    return quality.volatility_report(daily(spark, sf))


@register("volume_report", f"WITH {bars_sql()}, d AS (SELECT symbol, time::DATE AS d, sum(tick_volume)::BIGINT AS v FROM b GROUP BY 1, 2), q AS (SELECT symbol, quantile_cont(v, 0.9) AS hi, quantile_cont(v, 0.1) AS lo FROM d GROUP BY 1) SELECT symbol, sum(v)::BIGINT AS total, round(avg(v), 6) AS daily_mean, count(*) FILTER (WHERE v > hi) AS high_days, count(*) FILTER (WHERE v < lo) AS low_days FROM d JOIN q USING (symbol) GROUP BY 1")
def _(spark, sf):
    return quality.volume_report(bars(spark, sf))


@register("temporal_patterns", f"WITH {bars_sql()}, h AS (SELECT *, hour(time)::INTEGER AS hour FROM b), x AS (SELECT *, {CHG.format('hour')} AS r FROM h) SELECT symbol, hour, count(*) AS n, round(avg(tick_volume), 6) AS avg_volume, round(stddev_samp(r), 4) AS volatility FROM x GROUP BY 1, 2")
def _(spark, sf):
    return quality.temporal_patterns(bars(spark, sf))


ORIGINS = ", ".join(f"('{k}', {s}::DOUBLE, '{c}')" for k, (s, c) in DATA_ORIGINS.items())
CAT = f"cat(data_origin, quality_score, category) AS (VALUES {ORIGINS})"
TFM = "(['M5', 'M1', 'M10', 'M15', 'H1', 'ticks', 'other'])[(event_id % 7)::INTEGER + 1]"
METHOD = "(['native', 'aggregated', 'imputed_brownian', 'fallback', 'imputed_interpolation'])[(event_id % 5)::INTEGER + 1]"


def sourced(spark, sf):
    e = read_table(spark, sf, "events")
    tf = F.get(F.array(*[F.lit(x) for x in ("M5", "M1", "M10", "M15", "H1", "ticks", "other")]), (F.col("event_id") % 7).cast("int"))
    method = F.get(F.array(*[F.lit(x) for x in ("native", "aggregated", "imputed_brownian", "fallback", "imputed_interpolation")]), (F.col("event_id") % 5).cast("int"))
    return e.select(F.col("event_type").alias("symbol"), F.col("ts").alias("time"), F.col("value").alias("close"), F.col("event_id").alias("seq"), tf.alias("source_timeframe"), method.alias("capture_method"))


SOURCED = f"""s AS (SELECT event_type AS symbol, ts AS time, value AS close, event_id AS seq, {TFM} AS tf, {METHOD} AS m FROM events),
o AS (SELECT *, CASE WHEN m = 'imputed_brownian' THEN 'M5_IMPUTADO_BROWNIAN' WHEN m = 'imputed_interpolation' THEN 'M5_IMPUTADO_INTERPOLADO' WHEN m = 'aggregated' THEN CASE tf WHEN 'M5' THEN 'M5_NATIVO' WHEN 'ticks' THEN 'M5_AGREGADO_TICKS' WHEN 'other' THEN 'DESCONOCIDO' ELSE 'M5_AGREGADO_' || tf END
 WHEN m = 'fallback' THEN 'M5_FALLBACK' ELSE CASE tf WHEN 'ticks' THEN 'TICKS_NATIVO' WHEN 'other' THEN 'DESCONOCIDO' ELSE tf || '_NATIVO' END END AS data_origin FROM s), {CAT}, a AS (SELECT * FROM o LEFT JOIN cat USING (data_origin))"""


@register("lineage_assign", f"WITH {SOURCED} SELECT seq, data_origin, quality_score FROM a")
def _(spark, sf):
    return lineage.assign(sourced(spark, sf)).select("seq", "data_origin", "quality_score")


LEGACY = "(['real_m5', 'rates_range', 'aggregated', 'from_m1', 'imputed_brownian', 'imputed_interpolation', 'imputed', 'Ticks', 'other'])[(event_id % 9)::INTEGER + 1]"


LEGACY_SOURCES = "(['real_m5', 'aggregated_m1', 'aggregated_h1', 'imputed', 'other'])[(event_id % 5)::INTEGER + 1]"


@register("lineage_legacy", f"WITH x AS (SELECT event_id AS seq, {LEGACY} AS f, {TFM} AS tf FROM events) SELECT seq, CASE WHEN f = 'imputed_brownian' THEN 'M5_IMPUTADO_BROWNIAN' WHEN f = 'imputed_interpolation' THEN 'M5_IMPUTADO_INTERPOLADO' WHEN f = 'imputed' THEN 'M5_IMPUTADO_SIMPLE' WHEN f = 'Ticks' THEN 'M5_AGREGADO_TICKS' WHEN f IN ('real_m5', 'rates_range') THEN 'M5_NATIVO' WHEN f IN ('aggregated', 'from_m1') THEN 'M5_AGREGADO_M1' WHEN tf IN ('ticks', 'other') THEN 'DESCONOCIDO' ELSE tf || '_NATIVO' END AS data_origin FROM x")
def _(spark, sf):
    flag = F.get(F.array(*[F.lit(x) for x in ("real_m5", "rates_range", "aggregated", "from_m1", "imputed_brownian", "imputed_interpolation", "imputed", "Ticks", "other")]), (F.col("seq") % 9).cast("int"))
    return lineage.from_legacy(sourced(spark, sf).withColumn("data_flag", flag)).select("seq", "data_origin")


@register("lineage_granular", f"WITH {bars_sql()}, d AS (SELECT symbol, time, date_diff('microsecond', time, lead(time) OVER {W}) / 60e6 AS d FROM b), m AS (SELECT *, avg(d) OVER (PARTITION BY symbol ORDER BY time ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING) AS x FROM d), t(i, n, v) AS (VALUES (0, 'M1', 1), (1, 'M5', 5), (2, 'M10', 10), (3, 'M15', 15), (4, 'M20', 20), (5, 'M30', 30), (6, 'H1', 60)) SELECT symbol, time, CASE WHEN NOT {OPEN} THEN 'M5_FUERA_DE_HORARIO' WHEN x IS NULL THEN 'DESCONOCIDO' WHEN x < 0.75 THEN 'TICKS_NATIVO' ELSE (SELECT arg_min(n, struct_pack(a := abs(x - v), b := i)) || '_NATIVO' FROM t) END AS data_origin FROM m")
def _(spark, sf):
    return lineage.granular(bars(spark, sf).drop("data_origin")).select("symbol", "time", "data_origin")


@register("lineage_breakdown", f"WITH {SOURCED} SELECT symbol, category, count(*) AS n, round(avg(quality_score), 6) AS avg_score FROM a GROUP BY 1, 2")
def _(spark, sf):
    return lineage.breakdown(lineage.assign(sourced(spark, sf)), ("symbol",))


@register("quality_tracker", f"WITH {SOURCED} SELECT symbol, year(time)::INTEGER AS year, month(time)::INTEGER AS month, count(*) AS total, count(*) FILTER (WHERE data_origin = 'M5_NATIVO') AS native_m5, count(*) FILTER (WHERE data_origin = 'M5_AGREGADO_M1') AS aggregated_m1, count(*) FILTER (WHERE category = 'imputed') AS imputed, count(*) FILTER (WHERE data_origin NOT IN ('M5_NATIVO', 'M5_AGREGADO_M1') AND category <> 'imputed') AS other, round(avg(quality_score), 6) AS avg_score, count(DISTINCT data_origin) AS origins FROM a GROUP BY 1, 2, 3")
def _(spark, sf):
    return quality.track(lineage.assign(sourced(spark, sf)))


@register("worst_records", f"WITH {SOURCED} SELECT seq, quality_score FROM a ORDER BY quality_score, time, symbol LIMIT 100")
def _(spark, sf):
    return quality.worst_records(lineage.assign(sourced(spark, sf))).select("seq", "quality_score")


@register("completeness_heatmap", f"WITH {bars_sql()}, d AS (SELECT DISTINCT time::DATE AS date FROM b), g AS (SELECT date, unnest(range(24))::INTEGER AS hour FROM d), n AS (SELECT time::DATE AS date, hour(time)::INTEGER AS hour, count(*) AS n FROM b GROUP BY 1, 2) SELECT date, hour, 60 AS expected, coalesce(n, 0)::BIGINT AS captured, round(100.0 * coalesce(n, 0) / 60, 6) AS pct FROM g LEFT JOIN n USING (date, hour)")
def _(spark, sf):
    return quality.completeness_heatmap(bars(spark, sf).withColumn("quality_score", F.lit(1.0)), 60)


@register("hourly_analysis", f"WITH {bars_sql()}, h AS (SELECT hour(time)::INTEGER AS hour, count(*) AS n, round(avg(tick_volume), 6) AS avg_volume FROM b GROUP BY 1) SELECT *, CASE WHEN hour IN (9, 10) THEN 'opening' WHEN hour IN (15, 16) THEN 'closing' WHEN hour IN (12, 13) THEN 'lunch' ELSE 'other' END AS session FROM h")
def _(spark, sf):
    return quality.hourly_analysis(bars(spark, sf))


BAD = "(high < low OR high < greatest(open, close) OR low > least(open, close))"


@register("ohlc_integrity", f"WITH {bars_sql()}, x AS (SELECT *, {CHG1} AS chg FROM b) SELECT symbol, count(*) AS n, count(*) FILTER (WHERE {BAD}) AS order_violations, count(*) FILTER (WHERE least(open, high, low, close) <= 0) AS non_positive, count(*) FILTER (WHERE abs(chg) > 0.2) AS large_moves, count(*) FILTER (WHERE {BAD}) = 0 AS passed FROM x GROUP BY 1")
def _(spark, sf):
    return quality.ohlc_integrity(bars(spark, sf))


@register("m5_consistency", f"WITH {bars_sql()}, d AS (SELECT symbol, {DIFF} AS d FROM b) SELECT symbol, count(d) AS n, count(*) FILTER (WHERE d BETWEEN 4.5 AND 5.5) AS consistent, count(*) FILTER (WHERE d < 4.5) AS short, count(*) FILTER (WHERE d > 5.5) AS long, round(quantile_cont(d, 0.5), 6) AS median, count(*) FILTER (WHERE d BETWEEN 4.5 AND 5.5) >= 0.95 * count(d) AS passed FROM d GROUP BY 1")
def _(spark, sf):
    return quality.m5_consistency(bars(spark, sf))


@register("monotonicity", "WITH x AS (SELECT event_type AS symbol, ts, lag(ts) OVER (PARTITION BY event_type ORDER BY event_id) > ts AS back FROM events) SELECT symbol, count(*) FILTER (WHERE back) AS backward, count(*) - count(DISTINCT ts) AS duplicate_times, count(*) FILTER (WHERE back) = 0 AS monotonic FROM x GROUP BY 1")
def _(spark, sf):
    return quality.monotonicity(sourced(spark, sf))


@register("temporal_coverage", f"WITH {bars_sql('1 hour')}, d AS (SELECT symbol, time::DATE AS d, count(*) AS n FROM b GROUP BY 1, 2) SELECT symbol, count(*) AS days, count(*) FILTER (WHERE n = 24) AS perfect, count(*) FILTER (WHERE n >= 21.6 AND n <> 24) AS good, count(*) FILTER (WHERE n >= 16.8 AND n < 21.6) AS acceptable, count(*) FILTER (WHERE n < 16.8) AS poor FROM d GROUP BY 1")
def _(spark, sf):
    return quality.temporal_coverage(bars(spark, sf, "1 hour"), 24)


OUTSIDE = f"NOT (isodow({NY}) < 6 AND {SOD} BETWEEN 34200 AND 57600)"


@register("market_validation", f"WITH {bars_sql()} SELECT symbol, count(*) FILTER (WHERE isodow(time) > 5) AS weekend_rows, count(*) FILTER (WHERE {OUTSIDE}) AS outside_rows, round(100.0 * count(*) FILTER (WHERE NOT ({OUTSIDE})) / count(*), 6) AS pct_valid FROM b GROUP BY 1")
def _(spark, sf):
    return quality.market_validation(bars(spark, sf))


@register("null_summary", "WITH x AS (SELECT count(*) AS n, count(*) FILTER (WHERE v IS NULL) AS k FROM (SELECT CASE WHEN event_id % 3 <> 0 THEN value END AS v FROM events)) SELECT 'v' AS column_name, k AS nulls, round(100.0 * k / n, 6) AS pct FROM x")
def _(spark, sf):
    return quality.null_summary(holed(spark, sf), ["v"])


# Cleaning, scaling, selection.


def holed(spark, sf):
    return read_table(spark, sf, "events").select(F.col("event_type").alias("symbol"), F.col("ts").alias("time"), F.col("event_id").alias("seq"), F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("v"))


HOLED = "h AS (SELECT event_type AS symbol, ts AS time, event_id AS seq, CASE WHEN event_id % 3 <> 0 THEN value END AS v FROM events)"


@register("nan_fill_forward", f"WITH {HOLED} SELECT seq, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY time ROWS UNBOUNDED PRECEDING), first_value(v IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS v FROM h")
def _(spark, sf):
    return holed(spark, sf).select("seq", clean.fill_forward("v").alias("v"))


@register("nan_interpolate", f"""WITH {HOLED}, n AS (SELECT *, row_number() OVER {W} AS rn FROM h), k AS (SELECT *, CASE WHEN v IS NOT NULL THEN rn END AS kn FROM n),
p AS (SELECT seq, v, rn, last_value(v IGNORE NULLS) OVER a AS pv, last_value(kn IGNORE NULLS) OVER a AS pr, first_value(v IGNORE NULLS) OVER z AS nv, first_value(kn IGNORE NULLS) OVER z AS nr FROM k WINDOW a AS (PARTITION BY symbol ORDER BY time ROWS UNBOUNDED PRECEDING), z AS (PARTITION BY symbol ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT seq, round(coalesce(v, pv + (nv - pv) * (rn - pr) / nullif(nr - pr, 0), pv, nv), 6) AS v FROM p""")
def _(spark, sf):
    return clean.interpolate(holed(spark, sf), "v").select("seq", F.round("v", 6).alias("v"))


def items(spark, sf):
    return read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("x"))


def scaled(name: str, f, stats: str, expr: str) -> None:
    @register(name, f"WITH s AS (SELECT {stats} FROM lineitem) SELECT l_orderkey, l_linenumber, round({expr.replace('x', 'l_extendedprice')}, 6) AS x FROM lineitem, s")
    def run(spark, sf):
        return f(items(spark, sf)).select("l_orderkey", "l_linenumber", F.round("x", 6).alias("x"))


Q = "quantile_cont(l_extendedprice, {})"
scaled("winsorize", lambda d: clean.winsorize(d, "x"), f"{Q.format(0.001)} AS a, {Q.format(0.999)} AS b", "greatest(a, least(b, x))")
scaled("sigma_clip", lambda d: clean.sigma_clip(d, "x", 1.5), "avg(l_extendedprice) - 1.5 * stddev_samp(l_extendedprice) AS a, avg(l_extendedprice) + 1.5 * stddev_samp(l_extendedprice) AS b", "greatest(a, least(b, x))")
IQR = f"{Q.format(0.25)} - 0.25 * ({Q.format(0.75)} - {Q.format(0.25)}) AS a, {Q.format(0.75)} + 0.25 * ({Q.format(0.75)} - {Q.format(0.25)}) AS b"
scaled("iqr_clip", lambda d: clean.iqr_clip(d, "x", 0.25), IQR, "greatest(a, least(b, x))")
scaled("log_transform", lambda d: clean.log_transform(d, "x"), "min(l_extendedprice) AS a", "ln(1 + x)")
scaled("robust_scale", lambda d: clean.robust_scale(d, "x", "x"), f"{Q.format(0.5)} AS m, {Q.format(0.75)} - {Q.format(0.25)} AS w", "(x - m) / w")
scaled("standard_scale", lambda d: clean.standard_scale(d, "x", "x"), "avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS w", "(x - m) / w")
scaled("minmax_scale", lambda d: clean.minmax_scale(d, "x", "x"), "min(l_extendedprice) AS m, max(l_extendedprice) - min(l_extendedprice) AS w", "(x - m) / w")
NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LONG = "u AS (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c}::DOUBLE AS v FROM lineitem" for c in NUM) + ")"


@register("iqr_outliers", f"WITH {LONG}, q AS (SELECT column_name, quantile_cont(v, 0.25) AS a, quantile_cont(v, 0.75) AS b FROM u GROUP BY 1), l AS (SELECT column_name, a - 0.1 * (b - a) AS lo, b + 0.1 * (b - a) AS hi FROM q) SELECT column_name, count(*) FILTER (WHERE v < lo OR v > hi) AS n_outliers, round(100.0 * count(*) FILTER (WHERE v < lo OR v > hi) / count(*), 6) AS pct, round(any_value(lo), 6) AS lo, round(any_value(hi), 6) AS hi FROM u JOIN l USING (column_name) GROUP BY 1")
def _(spark, sf):
    return clean.iqr_outliers(read_table(spark, sf, "lineitem"), NUM, 0.1)


@register("variance_filter", f"WITH {LONG} SELECT column_name, round(var_pop(v), 4) AS variance, var_pop(v) > 1e-5 AS kept FROM u GROUP BY 1")
def _(spark, sf):
    return clean.variance_filter(read_table(spark, sf, "lineitem"), NUM)


@register("correlation_pairs", " UNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 4) AS corr FROM lineitem" for i, a in enumerate(NUM) for b in NUM[i + 1 :]))
def _(spark, sf):
    return clean.correlation_pairs(read_table(spark, sf, "lineitem"), NUM)


@register("rf_importance")
def _(spark, sf):
    return clean.forest_importance(read_table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")


# Splits.
I_SQL = f"i AS (SELECT symbol, time, row_number() OVER {W} - 1 AS i, count(*) OVER (PARTITION BY symbol) AS n FROM b)"


def labels(df):
    return df.select("symbol", "time", "split_id", "role")


@register("split_ratio", f"WITH {bars_sql('1 hour')}, {I_SQL}, x AS (SELECT symbol, time, 0 AS split_id, CASE WHEN i < floor(n * 0.8) - 5 THEN 'train' WHEN i >= floor(n * 0.8) THEN 'validation' END AS role FROM i) SELECT * FROM x WHERE role IS NOT NULL")
def _(spark, sf):
    return labels(clean.split_ratio(bars(spark, sf, "1 hour"), 0.8, 5))


@register("split_years", f"WITH {DAILY_SQL} SELECT symbol, time, 0 AS split_id, CASE WHEN year(time) <= 1995 THEN 'train' WHEN year(time) = 1996 THEN 'validation' ELSE 'test' END AS role FROM b WHERE year(time) BETWEEN 1992 AND 1998")
def _(spark, sf):
    return labels(clean.split_years(daily(spark, sf), (1992, 1995), (1996, 1996), (1997, 1998)))


@register("split_walk_forward", f"WITH {bars_sql('1 hour')}, {I_SQL}, s AS (SELECT *, unnest(range(3))::INTEGER AS split_id, n // 4 AS v FROM i), x AS (SELECT symbol, time, split_id, CASE WHEN i < n - (3 - split_id) * v - 2 THEN 'train' WHEN i >= n - (3 - split_id) * v AND i < n - (2 - split_id) * v THEN 'validation' END AS role FROM s) SELECT * FROM x WHERE role IS NOT NULL")
def _(spark, sf):
    return labels(clean.split_walk_forward(bars(spark, sf, "1 hour"), 3, 2))


@register("split_expanding", f"WITH {bars_sql('1 hour')}, {I_SQL}, s AS (SELECT *, unnest(range(4))::INTEGER AS split_id FROM i), x AS (SELECT symbol, time, split_id, CASE WHEN i < 100 + 50 * split_id THEN 'train' WHEN i < 140 + 50 * split_id THEN 'validation' END AS role FROM s WHERE 140 + 50 * split_id <= n) SELECT * FROM x WHERE role IS NOT NULL")
def _(spark, sf):
    return labels(clean.split_expanding(bars(spark, sf, "1 hour"), 100, 40, 50, 4))


@register("split_months", f"WITH {DAILY_SQL}, m AS (SELECT date_trunc('month', min(time))::DATE AS a, max(time)::DATE AS z FROM b), s AS (SELECT (a + INTERVAL 1 MONTH * (12 * k))::DATE AS s, (a + INTERVAL 1 MONTH * (12 * k + 12))::DATE AS m, (a + INTERVAL 1 MONTH * (12 * k + 15))::DATE AS e, k::INTEGER AS split_id, z FROM m, range(12) AS r(k)) SELECT symbol, time, split_id, CASE WHEN time::DATE < m THEN 'train' ELSE 'validation' END AS role FROM b JOIN s ON time::DATE >= s.s AND time::DATE < s.e WHERE s.e <= s.z")
def _(spark, sf):
    return labels(clean.split_months(daily(spark, sf), 12, 3, 12))


@register("split_dates", f"WITH {DAILY_SQL}, x AS (SELECT symbol, time, 0 AS split_id, CASE WHEN time BETWEEN TIMESTAMP '1992-01-01' AND TIMESTAMP '1994-12-31' THEN 'train' WHEN time BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1995-06-30' THEN 'validation' END AS role FROM b) SELECT * FROM x WHERE role IS NOT NULL")
def _(spark, sf):
    return labels(clean.split_dates(daily(spark, sf), [("1992-01-01", "1994-12-31", "1995-01-01", "1995-06-30")]))


@register("split_analysis", f"WITH {bars_sql('1 hour')}, {I_SQL}, x AS (SELECT symbol, time, CASE WHEN i < floor(n * 0.8) THEN 'train' ELSE 'validation' END AS role FROM i) SELECT symbol, 0 AS split_id, role, count(*) AS n, min(time) AS first_time, max(time) AS last_time, date_diff('day', min(time)::DATE, max(time)::DATE)::INTEGER AS days FROM x GROUP BY 1, 3")
def _(spark, sf):
    return clean.split_analysis(clean.split_ratio(bars(spark, sf, "1 hour"), 0.8))


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


from . import more  # noqa: E402, F401  (registers the rest)
