"""Cleaning, clipping, normalising, selecting and splitting. Statistics come from one aggregate, joined by broadcast of a
single row (or one row a symbol), never from a collect per column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def repair_bars(bars: DataFrame) -> DataFrame:
    """Distinct rows; high and low widened where they are crossed; negative volumes clamped to 0."""
    o, h, low, c = (F.col(x) for x in ("open", "high", "low", "close"))
    return bars.dropDuplicates().withColumns({"high": F.greatest(h, o, c), "low": F.least(low, o, c), "tick_volume": F.greatest("tick_volume", F.lit(0)), "real_volume": F.greatest("real_volume", F.lit(0))})


def clean_bars(bars: DataFrame, seq: str = "seq") -> DataFrame:
    """Drops null times or prices and impossible bars; first row of each time."""
    ok = (F.col("high") >= F.col("low")) & F.col("open").between(F.col("low"), F.col("high")) & F.col("close").between(F.col("low"), F.col("high"))
    w = Window.partitionBy("symbol", "time").orderBy(seq)
    return bars.dropna(subset=["time", "open", "high", "low", "close"]).where(ok).withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def known_around(col: str | Column, keys=("symbol",), order=("time",)) -> tuple[Column, Column]:
    """The last known value up to each row and the next one from it on. Both are running values, in time linear in the rows:
    the next one is the last one of the reversed order."""
    c = F.col(col) if isinstance(col, str) else col
    run = lambda o: F.last(c, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(*o).rowsBetween(Window.unboundedPreceding, 0))
    return run(order), run([F.desc(x) for x in order])


def fill_forward(col: str, keys=("symbol",), order=("time",)) -> Column:
    """Forward, then backward, then 0."""
    return F.coalesce(*known_around(col, keys, order), F.lit(0).cast("double"))


def interpolate(df: DataFrame, cols: str | list[str], keys=("symbol",), order=("time",)) -> DataFrame:
    """Linear by row number in both directions; edges take the nearest value. All columns share two sorts."""
    cols = [cols] if isinstance(cols, str) else cols
    t = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    t = t.withColumns({f"__at_{i}": F.when(F.col(c).isNotNull(), F.struct(F.col(c).cast("double").alias("v"), F.col("__rn").alias("r"))) for i, c in enumerate(cols)})
    around = [known_around(f"__at_{i}", keys, order) for i in range(len(cols))]
    t = t.withColumns({f"__p_{i}": p for i, (p, _) in enumerate(around)}).withColumns({f"__n_{i}": n for i, (_, n) in enumerate(around)})

    def value(i: int, c: str) -> Column:
        p, n = F.col(f"__p_{i}"), F.col(f"__n_{i}")
        lerp = p["v"] + (n["v"] - p["v"]) * F.try_divide(F.col("__rn") - p["r"], n["r"] - p["r"])
        return F.coalesce(F.col(c), lerp, p["v"], n["v"])

    return t.withColumns({c: value(i, c) for i, c in enumerate(cols)}).drop("__rn", *[f"__{x}_{i}" for x in ("at", "p", "n") for i in range(len(cols))])


def with_stats(df: DataFrame, **stats: Column) -> DataFrame:
    return df.join(F.broadcast(df.agg(*[v.alias(k) for k, v in stats.items()])), F.lit(True))


def clip(col: str, low: Column | str, high: Column | str) -> Column:
    as_col = lambda x: F.col(x) if isinstance(x, str) else x
    return F.greatest(as_col(low), F.least(as_col(high), F.col(col)))


def winsorize(df: DataFrame, col: str, lo: float = 0.001, hi: float = 0.999) -> DataFrame:
    t = with_stats(df, __lo=F.percentile(col, lo), __hi=F.percentile(col, hi))
    return t.withColumn(col, clip(col, "__lo", "__hi")).drop("__lo", "__hi")


def sigma_clip(df: DataFrame, col: str, k: float = 5.0) -> DataFrame:
    t = with_stats(df, __m=F.avg(col), __s=F.stddev_samp(col))
    return t.withColumn(col, clip(col, F.col("__m") - k * F.col("__s"), F.col("__m") + k * F.col("__s"))).drop("__m", "__s")


def iqr_clip(df: DataFrame, col: str, k: float = 1.5) -> DataFrame:
    t = with_stats(df, __a=F.percentile(col, 0.25), __b=F.percentile(col, 0.75))
    w = F.col("__b") - F.col("__a")
    return t.withColumn(col, clip(col, F.col("__a") - k * w, F.col("__b") + k * w)).drop("__a", "__b")


def iqr_outliers(df: DataFrame, cols: list[str], k: float = 1.5) -> DataFrame:
    """(column_name, n_outliers, pct, lo, hi) for each column; one pass for the quartiles, one for the counts."""
    long = df.unpivot([], [F.col(c).cast("double").alias(c) for c in cols], "column_name", "v")
    q = long.groupBy("column_name").agg(F.percentile("v", 0.25).alias("a"), F.percentile("v", 0.75).alias("b"))
    q = q.select("column_name", (F.col("a") - k * (F.col("b") - F.col("a"))).alias("lo"), (F.col("b") + k * (F.col("b") - F.col("a"))).alias("hi"))
    out = F.count_if((F.col("v") < F.col("lo")) | (F.col("v") > F.col("hi")))
    return long.join(F.broadcast(q), "column_name").groupBy("column_name", "lo", "hi").agg(out.alias("n_outliers"), F.round(100.0 * out / F.count("*"), 6).alias("pct")).select("column_name", "n_outliers", "pct", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"))


def log_transform(df: DataFrame, col: str) -> DataFrame:
    t = with_stats(df, __m=F.min(col))
    return t.withColumn(col, F.when(F.col("__m") >= 0, F.log1p(col)).otherwise(F.col(col))).drop("__m")


def robust_scale(df: DataFrame, col: str, out: str) -> DataFrame:
    t = with_stats(df, __m=F.percentile(col, 0.5), __w=F.percentile(col, 0.75) - F.percentile(col, 0.25))
    return t.withColumn(out, (F.col(col) - F.col("__m")) / F.when(F.col("__w") == 0, 1.0).otherwise(F.col("__w"))).drop("__m", "__w")


def standard_scale(df: DataFrame, col: str, out: str) -> DataFrame:
    t = with_stats(df, __m=F.avg(col), __s=F.stddev_pop(col))
    return t.withColumn(out, (F.col(col) - F.col("__m")) / F.when(F.col("__s") == 0, 1.0).otherwise(F.col("__s"))).drop("__m", "__s")


def minmax_scale(df: DataFrame, col: str, out: str) -> DataFrame:
    t = with_stats(df, __a=F.min(col), __b=F.max(col))
    return t.withColumn(out, (F.col(col) - F.col("__a")) / F.when(F.col("__b") == F.col("__a"), 1.0).otherwise(F.col("__b") - F.col("__a"))).drop("__a", "__b")


class Scaler:
    """Fits one method on some rows (say, the training split) and applies it to others. Parameters are one small row."""

    def __init__(self, method: str, cols: list[str]):
        self.method, self.cols = method, cols

    def fit(self, df: DataFrame) -> Scaler:
        mid, width = {
            "robust": (lambda c: F.percentile(c, 0.5), lambda c: F.percentile(c, 0.75) - F.percentile(c, 0.25)),
            "standard": (F.avg, F.stddev_pop),
            "minmax": (F.min, lambda c: F.max(c) - F.min(c)),
        }[self.method]
        row = df.agg(*[f(c).cast("double").alias(f"{k}_{c}") for c in self.cols for k, f in (("mid", mid), ("width", width))]).first()
        self.params = row.asDict()
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - self.params[f"mid_{c}"]) / (self.params[f"width_{c}"] or 1.0) for c in self.cols})


def relative_price(bars: DataFrame, col: str = "close", n: int = 20, least: int = 10) -> Column:
    w = Window.partitionBy("symbol").orderBy("time").rowsBetween(-(n - 1), 0)
    return F.when(F.count("close").over(w) >= least, F.try_divide(F.col(col), F.avg("close").over(w)))


# Feature selection.


def variance_filter(df: DataFrame, cols: list[str], least: float = 1e-5) -> DataFrame:
    one = df.agg(*[F.var_pop(c).alias(c) for c in cols])
    return one.unpivot([], cols, "column_name", "variance").select("column_name", F.round("variance", 4).alias("variance"), (F.col("variance") > least).alias("kept"))


def correlation(a: str, b: str) -> Column:
    """Of the rows that have both; null if either does not vary (the built-in one divides by zero)."""
    x, y = F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.covar_pop(a, b) / F.when(spread > 0, spread)


def correlation_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """(col_a, col_b, corr) of the upper triangle from one aggregate; null if a column does not vary."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    one = df.agg(*[correlation(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = one.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "c")
    return long.select(F.split_part("pair", F.lit("|"), F.lit(1)).alias("col_a"), F.split_part("pair", F.lit("|"), F.lit(2)).alias("col_b"), F.round("c", 4).alias("corr"))


def correlation_filter(df: DataFrame, cols: list[str], over: float = 0.95) -> list[str]:
    """Drops a column that is correlated with an earlier one; the pairs are a small table bounded by the columns."""
    high = {(r["col_a"], r["col_b"]) for r in correlation_pairs(df, cols).where(F.abs("corr") > over).collect()}
    return [c for i, c in enumerate(cols) if not any((a, c) in high for a in cols[:i])]


def forest_importance(df: DataFrame, cols: list[str], target: str, trees: int = 50, seed: int = 42) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    data = VectorAssembler(inputCols=cols, outputCol="x").transform(df.select(target, *cols).fillna(0).dropna(subset=[target]))
    model = RandomForestRegressor(featuresCol="x", labelCol=target, numTrees=trees, seed=seed, maxDepth=5).fit(data)
    return df.sparkSession.createDataFrame([(c, float(v)) for c, v in zip(cols, model.featureImportances.toArray(), strict=True)], "column_name string, importance double")


# Temporal splits: (split_id, role) labels, no copies kept.


def _numbered(df: DataFrame) -> DataFrame:
    w = Window.partitionBy("symbol")
    return df.withColumns({"__i": F.row_number().over(w.orderBy("time")) - 1, "__n": F.count("*").over(w)})


def split_ratio(df: DataFrame, ratio: float = 0.8, gap: int = 0) -> DataFrame:
    at = F.floor(F.col("__n") * ratio)
    role = F.when(F.col("__i") < at - gap, "train").when(F.col("__i") >= at, "validation")
    return _numbered(df).withColumn("role", role).where("role IS NOT NULL").withColumn("split_id", F.lit(0)).drop("__i", "__n")


def split_years(df: DataFrame, train=(2020, 2023), validation=(2024, 2024), test=(2025, 2025)) -> DataFrame:
    y = F.year("time")
    role = F.when(y.between(*train), "train").when(y.between(*validation), "validation").when(y.between(*test), "test")
    return df.withColumn("role", role).where("role IS NOT NULL").withColumn("split_id", F.lit(0))


def split_walk_forward(df: DataFrame, k: int = 3, gap: int = 0) -> DataFrame:
    """Split s trains on all rows before its validation block; blocks have n // (k + 1) rows and end with the data."""
    t = _numbered(df).withColumn("split_id", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    val = F.floor(F.col("__n") / (k + 1))
    start = F.col("__n") - (k - F.col("split_id")) * val
    role = F.when(F.col("__i") < start - gap, "train").when((F.col("__i") >= start) & (F.col("__i") < start + val), "validation")
    return t.withColumn("role", role).where("role IS NOT NULL").drop("__i", "__n")


def split_expanding(df: DataFrame, initial: int, val: int, step: int, max_splits: int = 5) -> DataFrame:
    t = _numbered(df).withColumn("split_id", F.explode(F.sequence(F.lit(0), F.lit(max_splits - 1))))
    end = initial + F.col("split_id") * step
    role = F.when(F.col("__i") < end, "train").when((F.col("__i") >= end) & (F.col("__i") < end + val), "validation")
    return t.where(end + val <= F.col("__n")).withColumn("role", role).where("role IS NOT NULL").drop("__i", "__n")


def split_dates(df: DataFrame, splits: list[tuple[str, str, str, str]]) -> DataFrame:
    """Inclusive bounds (train_start, train_end, val_start, val_end), one row a split."""
    rows = [(i, *s) for i, s in enumerate(splits)]
    t = df.sparkSession.createDataFrame(rows, "split_id int, a string, b string, c string, d string")
    t = t.select("split_id", *[F.col(x).cast("timestamp_ntz").alias(f"__{x}") for x in "abcd"])
    joined = df.join(F.broadcast(t), F.col("time").between(F.col("__a"), F.col("__b")) | F.col("time").between(F.col("__c"), F.col("__d")))
    return joined.withColumn("role", F.when(F.col("time").between(F.col("__a"), F.col("__b")), "train").otherwise("validation")).drop("__a", "__b", "__c", "__d")


def split_months(df: DataFrame, train: int, val: int, step: int, max_splits: int = 12, min_train: int = 0, min_val: int = 0) -> DataFrame:
    """Half-open calendar windows from the first month on, emitted while they end by the last row."""
    span = df.groupBy("symbol").agg(F.min(F.trunc("time", "month")).alias("a"), F.max(F.to_date("time")).alias("z"))
    t = span.withColumn("split_id", F.explode(F.sequence(F.lit(0), F.lit(max_splits - 1))))
    t = t.withColumns({"__s": F.add_months("a", F.col("split_id") * step)}).withColumns({"__m": F.add_months("__s", train), "__e": F.add_months("__s", train + val)}).where("__e <= z").drop("a", "z")
    d = F.to_date("time")
    joined = df.join(F.broadcast(t), "symbol").where((d >= F.col("__s")) & (d < F.col("__e"))).withColumn("role", F.when(d < F.col("__m"), "train").otherwise("validation")).drop("__s", "__m", "__e")
    if not (min_train or min_val):
        return joined
    ok = joined.groupBy("symbol", "split_id").agg(F.count_if(F.col("role") == "train").alias("t"), F.count_if(F.col("role") == "validation").alias("v")).where((F.col("t") >= min_train) & (F.col("v") >= min_val))
    return joined.join(ok.select("symbol", "split_id"), ["symbol", "split_id"], "left_semi")


def split_analysis(split: DataFrame) -> DataFrame:
    return split.groupBy("symbol", "split_id", "role").agg(F.count("*").alias("n"), F.min("time").alias("first_time"), F.max("time").alias("last_time"), F.date_diff(F.max(F.to_date("time")), F.min(F.to_date("time"))).alias("days"))
