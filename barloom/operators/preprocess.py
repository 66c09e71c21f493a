"""Cleaning, normalising and selecting columns by category: whole steps made of the single operations in `clean`.

Categories decide what happens to a column; all columns of one treatment share their sorts and one row of statistics.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .clean import clip, correlation_pairs, forest_importance, interpolate, known_around, variance_filter, with_stats

# Columns by category, and what cleaning does with each.
CLEANING = {
    "returns": ("zero", "winsorize", ["log_return", "return_5m", "volume_change", "volume_delta"]),
    "technical_indicators": ("interpolate", "clip", ["rsi_14", "rsi_28", "stochastic_k", "stochastic_d", "macd", "macd_signal", "macd_histogram", "atr_14", "sma_20", "sma_20_slope", "realized_vol_20", "cb_level"]),
    "volume": ("forward", "log", ["tick_volume", "volume_sma_20", "volume_ratio"]),
    "price": ("interpolate", "none", ["open", "high", "low", "close", "vwap", "adj_factor"]),
    "binary": ("zero", "none", ["doji", "hammer", "shooting_star", "bullish_engulfing", "bearish_engulfing"]),
    "temporal": ("none", "none", ["hour_sin", "hour_cos", "minute_sin", "minute_cos"]),
    "market_status": ("forward", "none", ["halt_flag"]),
}
SCALING = {
    "price": ["open", "high", "low", "close", "vwap", "adj_factor"],
    "volume": ["tick_volume", "volume_sma_20", "volume_relative", "volume_ratio", "volume_delta"],
    "technical_bounded": ["rsi_14", "rsi_28", "stochastic_k", "stochastic_d", "percent_r"],
    "technical_unbounded": ["macd", "macd_signal", "macd_histogram", "atr_14", "bollinger_width", "cb_level"],
    "returns": ["log_return", "return_5m", "cumulative_return_session"],
    "temporal": ["hour_sin", "hour_cos", "minute_sin", "minute_cos", "dow_sin", "dow_cos"],
    "binary": ["doji", "hammer", "shooting_star", "bullish_engulfing", "bearish_engulfing", "halt_flag"],
    "session": ["session_progress"],
}
RECOMMENDED = "open high low close log_return ema_21 ema_55 sma_200 atr_14 volatility_20 rsi_14 macd_histogram hour_sin hour_cos dow_sin dow_cos vwap volume_ratio doji bullish_engulfing bearish_engulfing minutes_since_open minutes_to_close session_progress".split()
MANDATORY = ["time", "data_flag"]

KEYS = ("symbol", "time")


def numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def treatment(df: DataFrame, which: int) -> dict[str, str]:
    """{column: treatment}; which 0: of nulls, 1: of outliers. Numeric columns of no category are filled forward."""
    known = {c: CLEANING[k][which] for k in CLEANING for c in CLEANING[k][2] if c in df.columns}
    return known | ({c: "forward" for c in numeric(df) if c not in known} if which == 0 else {})


# Nulls.


def mean_fill(df: DataFrame, col: str, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Nulls become the symbol's mean, summed before the shuffle and joined as one row a symbol."""
    means = df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.avg(col).alias("__mean"))
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"__{k}"))
    return df.join(means, same, "left").withColumn(col, F.coalesce(F.col(col).cast("double"), "__mean")).drop("__mean", *[f"__{k}" for k in keys])


def clean_nulls(df: DataFrame, keys=("symbol",), order=("time",)) -> DataFrame:
    """Every numeric column filled by its category; what a method leaves is filled forward, backward, then with 0."""
    how = treatment(df, 0)
    lerp = [c for c, m in how.items() if m == "interpolate"]
    t = interpolate(df, lerp, keys, order) if lerp else df
    zero = {c: F.coalesce(F.col(c), F.lit(0).cast(t.schema[c].dataType)) for c, m in how.items() if m in ("zero", "interpolate")}
    run = {c: F.coalesce(*known_around(c, keys, order), F.lit(0).cast(t.schema[c].dataType)) for c, m in how.items() if m in ("forward", "none")}
    return t.withColumns(zero | run)


def null_report(df: DataFrame) -> DataFrame:
    """(column_name, original_nulls, pct, method) of each numeric column that has nulls."""
    how = treatment(df, 0)
    one = df.agg(F.count("*").alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in how])
    names = F.create_map(*[F.lit(x) for pair in how.items() for x in pair])
    long = one.unpivot(["__n"], list(how), "column_name", "original_nulls").where("original_nulls > 0")
    return long.select("column_name", "original_nulls", F.round(100.0 * F.col("original_nulls") / F.col("__n"), 6).alias("pct"), F.try_element_at(names, F.col("column_name")).alias("method"))


# Outliers.


def outlier_bounds(df: DataFrame, deviations: float = 5.0) -> dict[str, dict[str, Column]]:
    """{column: its statistics}: all go into one aggregate."""
    out = {}
    for c, m in treatment(df, 1).items():
        if m == "winsorize":
            out[c] = {f"__lo_{c}": F.percentile(c, 0.001), f"__hi_{c}": F.percentile(c, 0.999)}
        elif m == "clip":
            out[c] = {f"__lo_{c}": F.avg(c) - deviations * F.stddev_samp(c), f"__hi_{c}": F.avg(c) + deviations * F.stddev_samp(c)}
        elif m == "log":
            out[c] = {f"__lo_{c}": F.min(c), f"__hi_{c}": F.max(c)}
    return out


def handle_outliers(df: DataFrame, deviations: float = 5.0) -> DataFrame:
    """Returns clipped at the 0.1 % and 99.9 % points, indicators at so many deviations, volumes as log(1 + v) if none is negative."""
    bounds = outlier_bounds(df, deviations)
    if not bounds:
        return df
    how = treatment(df, 1)
    t = with_stats(df, **{k: v for own in bounds.values() for k, v in own.items()})
    new = {c: F.when(F.col(f"__lo_{c}") >= 0, F.log1p(c)).otherwise(F.col(c)) if how[c] == "log" else F.when(F.col(c).isNotNull(), clip(c, f"__lo_{c}", f"__hi_{c}")) for c in bounds}
    return t.withColumns(new).select(*[F.col(f"`{c}`") for c in df.columns])


def outlier_report(df: DataFrame, deviations: float = 5.0) -> DataFrame:
    """(column_name, treatment, n_outliers, pct): what `handle_outliers` clips."""
    bounds = {c: own for c, own in outlier_bounds(df, deviations).items() if treatment(df, 1)[c] != "log"}
    t = with_stats(df, **{k: v for own in bounds.values() for k, v in own.items()})
    one = t.agg(F.count("*").alias("__n"), *[F.count_if((F.col(c) < F.col(f"__lo_{c}")) | (F.col(c) > F.col(f"__hi_{c}"))).alias(c) for c in bounds])
    names = F.create_map(*[F.lit(x) for c in bounds for x in (c, treatment(df, 1)[c])])
    return one.unpivot(["__n"], list(bounds), "column_name", "n_outliers").select("column_name", F.try_element_at(names, F.col("column_name")).alias("treatment"), "n_outliers", F.round(100.0 * F.col("n_outliers") / F.col("__n"), 6).alias("pct"))


def quality_metrics(df: DataFrame, correlated: float = 0.95, least_variance: float = 1e-10) -> DataFrame:
    """One row: rows, nulls, repeated rows, columns of no variance, correlated pairs, impossible bars."""
    cols = numeric(df)
    bad = (F.col("high") < F.col("low")) | (F.col("high") < F.greatest("open", "close")) | (F.col("low") > F.least("open", "close")) if {"open", "high", "low", "close"} <= set(df.columns) else F.lit(False)
    flat = sum((F.coalesce(F.var_samp(c) < least_variance, F.lit(False)).cast("int") for c in cols), F.lit(0))
    one = df.agg(F.count("*").alias("n_rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"__null_{i}") for i, c in enumerate(df.columns)], flat.cast("int").alias("flat_columns"), F.count_if(bad).alias("bad_bars"))
    nulls = sum((F.col(f"__null_{i}") for i in range(len(df.columns))), F.lit(0)).cast("long")
    repeated = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("repeated_rows"))
    pairs = correlation_pairs(df, cols).agg(F.count_if(F.abs("corr") > correlated).cast("int").alias("correlated_pairs"))
    return one.select("n_rows", nulls.alias("nulls"), "flat_columns", "bad_bars").join(F.broadcast(repeated), F.lit(True)).join(F.broadcast(pairs), F.lit(True))


def final_cleanup(df: DataFrame) -> DataFrame:
    """Distinct rows, whole numbers for flags, time as a timestamp, no row with a null. Order is left to the sink."""
    flags = [c for k in ("binary", "market_status") for c in CLEANING[k][2] if c in df.columns]
    t = df.dropDuplicates().withColumns({c: F.col(c).cast("int") for c in flags})
    t = t.withColumn("time", F.col("time").cast("timestamp_ntz")) if "time" in t.columns else t
    return t.dropna()


def full_clean(df: DataFrame, deviations: float = 5.0) -> DataFrame:
    return final_cleanup(handle_outliers(clean_nulls(df), deviations))


def clean_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows and nulls before and after."""
    one = lambda df, p: df.agg(F.count("*").alias(f"rows_{p}"), sum((F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns), F.lit(0)).cast("long").alias(f"nulls_{p}"))
    return one(before, "before").join(F.broadcast(one(after, "after")), F.lit(True))


# Normalising.


def rolling(c: str, n: int = 20, least: int = 10) -> Column:
    w = Window.partitionBy("symbol").orderBy("time").rowsBetween(-(n - 1), 0)
    return F.when(F.count(c).over(w) >= least, F.avg(c).over(w))


def volume_relative(df: DataFrame, n: int = 20, least: int = 10) -> DataFrame:
    """tick_volume_log, tick_volume as log(1 + v) over the log of its rolling mean, other volumes over that mean (1 at least)."""
    mean = rolling("tick_volume", n, least)
    t = df.withColumns({"__mean": mean, "tick_volume_log": F.log1p("tick_volume")})
    others = {c: F.col(c) / F.greatest("__mean", F.lit(1.0)) for c in SCALING["volume"] if c in df.columns and c != "tick_volume"}
    others = {c: F.when(F.col("__mean").isNotNull(), v) for c, v in others.items()}
    return t.withColumns(others | {"tick_volume": F.try_divide(F.col("tick_volume_log"), F.log1p("__mean"))}).drop("__mean")


def technical_relative(df: DataFrame) -> DataFrame:
    """macd columns over atr_14 (0.001 at least), atr_14 over close, bollinger_width as it is, other unbounded ones scaled robustly."""
    own = [c for c in SCALING["technical_unbounded"] if c in df.columns]
    new: dict[str, Column] = {}
    for c in own:
        if "macd" in c and "atr_14" in df.columns:
            new[c] = F.col(c) / F.greatest("atr_14", F.lit(0.001))
        elif c == "atr_14":
            new[c] = F.try_divide(F.col(c), F.col("close"))
    rest = [c for c in own if "macd" not in c and c not in ("atr_14", "bollinger_width")]
    t = df
    if rest:
        t = with_stats(df, **{f"__m_{c}": F.percentile(c, 0.5) for c in rest}, **{f"__w_{c}": F.percentile(c, 0.75) - F.percentile(c, 0.25) for c in rest})
        new |= {c: (F.col(c) - F.col(f"__m_{c}")) / F.when(F.col(f"__w_{c}") == 0, 1.0).otherwise(F.col(f"__w_{c}")) for c in rest}
    return t.withColumns(new).drop(*[f"__{x}_{c}" for c in rest for x in "mw"])


def feature_specific(df: DataFrame, n: int = 20) -> DataFrame:
    """Prices but close over the rolling mean of close and volumes but tick_volume over that of tick_volume (1 where there is
    none), rsi and stochastic within 0 to 100, returns within ten deviations, session progress within 0 to 1."""
    has = lambda k: [c for c in SCALING[k] if c in df.columns]
    new: dict[str, Column] = {}
    for kind, of in (("price", "close"), ("volume", "tick_volume")):
        if of in df.columns:
            new |= {c: F.coalesce(F.try_divide(F.col(c), rolling(of, n, n)), F.lit(1.0)) for c in has(kind) if c != of}
    within = lambda c, lo, hi: F.when(F.col(c).isNotNull(), clip(c, lo, hi))
    new |= {c: within(c, F.lit(0.0), F.lit(100.0)) for c in has("technical_bounded") if c.startswith(("rsi", "stochastic"))}
    new |= {c: within(c, F.lit(0.0), F.lit(1.0)) for c in has("session")}
    back = has("returns")
    t = with_stats(df, **{f"__s_{c}": F.stddev_samp(c) for c in back}) if back else df
    new |= {c: F.when(F.col(f"__s_{c}") > 0, within(c, -10 * F.col(f"__s_{c}"), 10 * F.col(f"__s_{c}"))).otherwise(F.col(c)) for c in back}
    return t.withColumns(new).drop(*[f"__s_{c}" for c in back])


def normalisation_stats(df: DataFrame) -> DataFrame:
    """(category, column_name, mean, std, min, max) of every column that has a category."""
    kinds = {c: k for k, own in SCALING.items() for c in own if c in df.columns}
    parts = F.explode(F.array(*[F.struct(F.lit(k).alias("category"), F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c, k in kinds.items()])).alias("x")
    stats = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    return df.select(parts).select("x.*").groupBy("category", "column_name").agg(*[F.round(f("v"), 4).alias(n) for n, f in stats.items()])


def save_params(params: dict, path: str) -> None:
    """A scaler's parameters (two numbers a column) as JSON on the driver."""
    with open(path, "w") as f:
        json.dump(params, f, indent=1, sort_keys=True)


def load_params(path: str) -> dict:
    with open(path) as f:
        return json.load(f)


# Selecting.


def selection(df: DataFrame, target: str | None = None, least_variance: float = 1e-5, correlated: float = 0.95, heuristic: bool = True) -> tuple[DataFrame, dict]:
    """The table of the selected columns, and what every step decided. Only results a column long or a pair long come to the driver.

    Steps: variance, correlation with an earlier column, the recommended list, importance for a target (reported, not
    filtered), mandatory columns attached again.
    """
    cols = [c for c in numeric(df) if c not in MANDATORY]
    flat = sorted(r["column_name"] for r in variance_filter(df, cols, least_variance).collect() if not r["kept"])
    rest = [c for c in cols if c not in flat]
    high = {(r["col_a"], r["col_b"]) for r in correlation_pairs(df, rest).collect() if r["corr"] is not None and abs(r["corr"]) > correlated} if len(rest) > 1 else set()
    twins = [c for i, c in enumerate(rest) if any((a, c) in high for a in rest[:i])]
    left = [c for c in df.columns if c not in flat and c not in twins]
    kept = [c for c in [*RECOMMENDED, *MANDATORY] if c in left] if heuristic else left
    importance = forest_importance(df, [c for c in kept if c in rest and c != target], target).orderBy(F.desc("importance")).collect() if target else []
    final = kept + [c for c in MANDATORY if c in df.columns and c not in kept]
    info = {"constant": flat, "correlated": twins, "heuristic": kept if heuristic else [], "selected": final, "importance": {r["column_name"]: r["importance"] for r in importance}}
    return df.select(*[F.col(f"`{c}`") for c in final]), info


def selection_table(df: DataFrame, **how) -> DataFrame:
    """(column_name, step): the step that dropped a column, or `selected`."""
    _, info = selection(df, **how)
    step = lambda c: "constant" if c in info["constant"] else "correlated" if c in info["correlated"] else "selected" if c in info["selected"] else "not_recommended"
    return df.sparkSession.createDataFrame([(c, step(c)) for c in df.columns], "column_name string, step string")
