"""Linear recurrences y[t] = a * y[t-1] + b[t] as a two-level blocked scan: EMA, MACD, Wilder smoothing.

Blocks are so long that a**block is below 1e-20 while a**-block stays far from overflow: within a block the scan is a
cumulative sum of scaled inputs, and what reaches into a block comes from the end of the block before it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import chunked, numbered

__all__ = ["ema", "ema_family", "linear_scans", "macd", "numbered", "reach", "rsi_wilder", "smoothed"]

SPANS = (9, 21, 55, 100, 200)


def block_of(a: float) -> int:
    return math.ceil(48 / -math.log(a))


def linear_scans(chunk: DataFrame, specs: list[tuple[float, Column, str]]) -> DataFrame:
    """A column for each (a, b, out); b is never null. chunk: from `chunked`, reaching back two blocks of every a.

    A block's own part is a running sum of scaled inputs; what comes before it is the end of the block before, whose own
    past is below 1e-20 by then. All of it runs within a chunk: one exchange, no join.
    """
    number = F.col("__rn") - 1
    own, out = {}, {}
    for k, (a, b, _) in enumerate(specs):
        i = number % block_of(a)
        w = Window.partitionBy("symbol", "__chunk", F.floor(number / block_of(a))).orderBy("__rn").rowsBetween(Window.unboundedPreceding, 0)
        own[f"__y{k}"] = F.sum(b * F.pow(F.lit(a), -i)).over(w) * F.pow(F.lit(a), i)
    before = Window.partitionBy("symbol", "__chunk").orderBy("__rn").rowsBetween(Window.unboundedPreceding, -1)
    for k, (a, _, name) in enumerate(specs):
        end = F.last(F.when(F.col("__rn") % block_of(a) == 0, F.col(f"__y{k}")), ignorenulls=True).over(before)
        out[name] = F.col(f"__y{k}") + F.pow(F.lit(a), number % block_of(a) + 1) * F.coalesce(end, F.lit(0.0))
    return chunk.withColumns(own).withColumns(out).drop(*own)


def _ema(col: str, span: int, out: str) -> tuple[float, Column, str]:
    """Exponential moving average from the first value on."""
    alpha = 2 / (span + 1)
    return 1 - alpha, F.when(F.col("__rn") == 1, F.col(col)).otherwise(alpha * F.col(col)), out


def ema(df: DataFrame, col: str, span: int, out: str) -> DataFrame:
    """df numbered."""
    spec = _ema(col, span, out)
    return chunked(df, 2 * block_of(spec[0]), lambda c: linear_scans(c, [spec]))


def reach(emas: tuple[int, ...] = (), with_macd: bool = False, rsis: tuple[int, ...] = ()) -> int:
    """Rows that `smoothed` looks back."""
    alphas = [1 - 2 / (n + 1) for n in emas + (12, 26) * with_macd] + [(n - 1) / n for n in rsis]
    return 2 * max(map(block_of, alphas)) + (2 * block_of(0.8) if with_macd else 0) + max(rsis, default=0) + 2


def smoothed(chunk: DataFrame, emas: tuple[int, ...] = (), with_macd: bool = False, rsis: tuple[int, ...] = ()) -> DataFrame:
    """All recurrences asked for, beside a chunk's own columns.

    RSI: seeded by the mean of the first n changes, then smoothed by 1/n; null for the first n rows, 100 without losses.
    """
    w = Window.partitionBy("symbol", "__chunk").orderBy("__rn")
    t = chunk.withColumn("__c", F.col("close").cast("double"))
    specs = [_ema("__c", n, f"ema_{n}") for n in emas]
    if rsis:
        t = t.withColumn("__d", F.coalesce(F.col("__c") - F.lag("__c").over(w), F.lit(0.0)))
        t = t.withColumns({"__gain": F.greatest("__d", F.lit(0.0)), "__loss": F.greatest(-F.col("__d"), F.lit(0.0))})
        seeds = {f"__{side}_seed_{n}": F.sum(f"__{side}").over(w.rowsBetween(-n, 0)) / n for n in rsis for side in ("gain", "loss")}
        t = t.withColumns(seeds)
        # Nothing for n rows, then the first mean, then each change by its weight.
        fed = lambda side, n: F.when(F.col("__rn") <= n, 0.0).when(F.col("__rn") == n + 1, F.col(f"__{side}_seed_{n}")).otherwise(F.col(f"__{side}") / n)
        specs += [((n - 1) / n, fed(side, n), f"__{side}_{n}") for n in rsis for side in ("gain", "loss")]
    if with_macd:
        specs += [_ema("__c", 12, "__fast"), _ema("__c", 26, "__slow")]
    t = linear_scans(t, specs)
    if with_macd:
        t = linear_scans(t.withColumn("macd", F.col("__fast") - F.col("__slow")), [_ema("macd", 9, "macd_signal")]).withColumn("macd_histogram", F.col("macd") - F.col("macd_signal"))
    last = {f"ema_{n}_slope": F.col(f"ema_{n}") - F.lag(f"ema_{n}").over(w) for n in emas}
    for n in rsis:
        rs = F.when(F.col(f"__loss_{n}") == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + F.try_divide(F.col(f"__gain_{n}"), F.col(f"__loss_{n}"))))
        last[f"rsi_{n}"] = F.when(F.col("__rn") > n, rs)
    mine = {c for c in t.columns if c.startswith("__")} - set(chunk.columns)
    return t.withColumns(last).drop(*mine)


def _alone(bars: DataFrame, *what) -> DataFrame:
    return chunked(numbered(bars), reach(*what), lambda c: smoothed(c, *what)).drop("__rn")


def ema_family(bars: DataFrame, spans: tuple[int, ...] = SPANS) -> DataFrame:
    return _alone(bars, spans)


def macd(bars: DataFrame) -> DataFrame:
    return _alone(bars, (), True)


def rsi_wilder(bars: DataFrame, n: int = 14) -> DataFrame:
    return _alone(bars, (), False, (n,))
