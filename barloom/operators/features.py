"""Feature columns over bars: one window specification, a few dependency levels, one projection each.

Each builder returns {name: Column}; `add` projects them at once, so windows of one specification share one sort.
"""

from __future__ import annotations

import math
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.catalog import BARS_PER_YEAR

ANNUAL = math.sqrt(BARS_PER_YEAR)
#: What windows partition by while columns are built; `all_features` adds the chunk.
_KEYS: ContextVar[tuple[str, ...]] = ContextVar("keys", default=("symbol",))
#: Rows that the widest chain of windows looks back: 200 of a moving average and one of its slope, and some to spare.
REACH = 256


def W():
    return Window.partitionBy(*_KEYS.get()).orderBy("time")


def C() -> Column:
    return F.col("close")


def O() -> Column:
    return F.col("open")


def H() -> Column:
    return F.col("high")


def L() -> Column:
    return F.col("low")


def V() -> Column:
    return F.col("tick_volume")


def R(n: int):
    return W().rowsBetween(-(n - 1), 0)


def full(agg: Column, col: Column | str, n: int) -> Column:
    """The aggregate over n rows, null until n non-null values are there."""
    return F.when(F.count(col).over(R(n)) == n, agg.over(R(n)))


def before(c: Column | str) -> Column:
    return F.lag(c).over(W())


def add(bars: DataFrame, *groups: dict[str, Column]) -> DataFrame:
    for g in groups:
        bars = bars.withColumns(g)
    return bars


def returns() -> dict[str, Column]:
    p = before("close")
    simple = F.when(p.isNull() | (p == 0), 0.0).otherwise(F.try_divide(C() - p, p))
    log = F.when(p.isNull() | (p <= 0) | (C() <= 0), 0.0).otherwise(F.ln(F.try_divide(C(), p)))
    return {"returns": simple, "log_return": log, "price_change": C() - p}


def candle_shape() -> dict[str, Column]:
    return {"high_low_range": H() - L(), "high_low_pct": F.try_divide(H() - L(), C()) * 100, "body": C() - O(), "body_pct": F.try_divide(C() - O(), C()) * 100, "upper_shadow": F.greatest(O(), C()) - H(), "lower_shadow": L() - F.least(O(), C())}


def sma_family(spans=(20, 50, 100, 200)) -> dict[str, Column]:
    return {f"sma_{n}": F.avg("close").over(R(n)) for n in spans}


def sma_slopes(spans=(20, 50, 100, 200)) -> dict[str, Column]:
    return {f"sma_{n}_slope": F.col(f"sma_{n}") - before(f"sma_{n}") for n in spans}


def rsi_sma(n: int = 14) -> list[dict[str, Column]]:
    """Plain rolling means instead of Wilder's smoothing; two levels."""
    d = C() - before("close")
    gain, loss = full(F.avg("__up"), "__up", n), full(F.avg("__down"), "__down", n)
    return [{"__up": F.when(d.isNotNull(), F.greatest(d, F.lit(0.0))), "__down": F.when(d.isNotNull(), F.greatest(-d, F.lit(0.0)))}, {f"rsi_sma_{n}": F.when(loss == 0, 100.0).otherwise(100 - 100 / (1 + F.try_divide(gain, loss)))}]


def bollinger(spans=(20, 30), widths=(2, 3)) -> dict[str, Column]:
    out = {}
    for n in spans:
        mid, std = full(F.avg("close"), "close", n), full(F.stddev_samp("close"), "close", n)
        for k in widths:
            up, low = mid + k * std, mid - k * std
            out |= {f"bb_upper_{n}_{k}": up, f"bb_lower_{n}_{k}": low, f"bb_width_{n}_{k}": up - low, f"bb_position_{n}_{k}": F.try_divide(C() - low, up - low)}
    return out


def atr(spans=(14, 21)) -> list[dict[str, Column]]:
    p = before("close")
    return [{"__tr": F.greatest(H() - L(), F.abs(H() - p), F.abs(L() - p))}, {f"atr_{n}": full(F.avg("__tr"), "__tr", n) for n in spans}]


def stochastic(spans=(14, 21)) -> list[dict[str, Column]]:
    k = {f"stoch_k_{n}": F.try_divide(100 * (C() - full(F.min("low"), "low", n)), full(F.max("high"), "high", n) - full(F.min("low"), "low", n)) for n in spans}
    return [k, {f"stoch_d_{n}": full(F.avg(f"stoch_k_{n}"), f"stoch_k_{n}", 3) for n in spans}]


def volatility(spans=(10, 20, 30)) -> dict[str, Column]:
    return {f"volatility_{n}": full(F.stddev_samp("log_return"), "log_return", n) * ANNUAL for n in spans}


def parkinson(n: int = 20) -> list[dict[str, Column]]:
    return [{"__hl": F.pow(F.ln(F.try_divide(H(), L())), 2)}, {"parkinson_vol": F.sqrt(full(F.avg("__hl"), "__hl", n) / (4 * math.log(2))) * ANNUAL}]


def volume_features(n: int = 20) -> dict[str, Column]:
    mean = full(F.avg("tick_volume"), "tick_volume", n)
    return {"volume_sma_20": mean, "volume_ratio": F.try_divide(V(), mean), "volume_change": F.try_divide(V() - before("tick_volume"), before("tick_volume"))}


def vwap(n: int = 20) -> list[dict[str, Column]]:
    return [{"__cv": C() * V()}, {"vwap": F.try_divide(full(F.sum("__cv"), "__cv", n), full(F.sum("tick_volume"), "tick_volume", n))}, {"price_to_vwap": F.try_divide(C(), F.col("vwap"))}]


def calendar_features() -> dict[str, Column]:
    t = F.col("time")
    return {"hour": F.hour(t), "minute": F.minute(t), "day_of_week": F.weekday(t), "day_of_month": F.dayofmonth(t), "month": F.month(t), "quarter": F.quarter(t)}


def cyclic_features() -> dict[str, Column]:
    parts = {"hour": (F.hour("time"), 24), "minute": (F.minute("time"), 60), "dow": (F.weekday("time"), 7)}
    return {f"{k}_{name}": f(2 * math.pi * x / n) for k, (x, n) in parts.items() for name, f in (("sin", F.sin), ("cos", F.cos))}


def session_features() -> dict[str, Column]:
    h, m = F.hour("time"), F.minute("time")
    since, to = (h - 9) * 60 + m - 30, (16 - h) * 60 - m
    flag = lambda c: c.cast("int")
    return {"minutes_since_open": since, "minutes_to_close": to, "session_progress": since / 390.0, "is_first_hour": flag(since <= 60), "is_last_hour": flag(to <= 60), "is_lunch_time": flag((h >= 12) & (h < 14)), "is_morning": flag(h < 12), "is_afternoon": flag(h >= 12)}


def structure_patterns() -> dict[str, Column]:
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    ph, pl, po, pc = before("high"), before("low"), before("open"), before("close")
    body, pbody = C() - O(), pc - po
    return {
        "higher_high": flag(ph < H()), "lower_low": flag(pl > L()), "higher_low": flag(pl < L()), "lower_high": flag(ph > H()), "doji": flag(F.abs(F.try_divide(body, C()) * 100) < 0.1),
        "bullish_engulfing": flag((body > 0) & (pbody < 0) & (pc > O()) & (po < C())), "bearish_engulfing": flag((body < 0) & (pbody > 0) & (pc < O()) & (po > C())),
    }


def cumulative_returns() -> dict[str, Column]:
    over = lambda *k: F.sum("returns").over(Window.partitionBy("symbol", *k).orderBy("time").rowsBetween(Window.unboundedPreceding, 0))
    return {"cumulative_return_day": over(F.to_date("time")), "cumulative_return_week": over(F.year("time"), F.weekofyear("time"))}


def rolling_stats(spans=(20, 50)) -> dict[str, Column]:
    out = {}
    for n in spans:
        low, high = F.min("close").over(R(n)), F.max("close").over(R(n))
        out |= {f"rolling_mean_{n}": F.avg("close").over(R(n)), f"rolling_std_{n}": F.stddev_pop("close").over(R(n)), f"rolling_min_{n}": low, f"rolling_max_{n}": high, f"rolling_range_{n}": high - low}
    return out


def _windowed(bars: DataFrame) -> DataFrame:
    level1 = {**returns(), **candle_shape(), **sma_family(), **bollinger(), **volume_features(), **structure_patterns(), **rolling_stats(), **atr()[0], **stochastic()[0], **parkinson()[0], **vwap()[0]}
    level2 = {**sma_slopes(), **atr()[1], **stochastic()[1], **volatility(), **parkinson()[1], **vwap()[1]}
    return add(bars, level1, level2, vwap()[2])


def all_features(bars: DataFrame) -> DataFrame:
    """The full set: rolling columns and recurrences in one pass chunk by chunk, then scalars and sums by day and week."""
    from .blocks import chunked, numbered
    from .recurrence import SPANS, reach, smoothed

    what = (SPANS, True, (14, 21, 28))
    token = _KEYS.set(("symbol", "__chunk"))
    try:
        t = chunked(numbered(bars), max(REACH, reach(*what)), lambda c: smoothed(_windowed(c), *what))
    finally:
        _KEYS.reset(token)
    t = t.drop("__tr", "__hl", "__cv", "__rn")
    return add(t, {**calendar_features(), **cyclic_features(), **session_features(), **cumulative_returns()})
