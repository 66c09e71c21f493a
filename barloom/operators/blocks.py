"""Splitting a symbol: one symbol may hold most rows, so nothing that looks along time may need it whole in one task.

`numbered` counts rows by time blocks and adds what came before (a small table of totals). `chunked` then deals numbered
rows into chunks and gives each chunk the last rows of the one before it, so windows of bounded reach run chunk by chunk.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds of a block that rows are counted in, and rows of a chunk.
BLOCK_SECONDS = 30 * 86400
CHUNK_ROWS = 50_000


def time_block(time: str, seconds: int = BLOCK_SECONDS) -> Column:
    return F.floor(F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(time).cast("timestamp_ntz")) / seconds)


def numbered(df: DataFrame, keys: tuple[str, ...] = ("symbol",), time: str = "time", out: str = "__rn", tie: tuple[str, ...] = ()) -> DataFrame:
    """The row's number (from 1) by time within its keys; rows of one time in the order of `tie`."""
    t = df.withColumn("__block", F.coalesce(time_block(time), F.lit(-(2**40))))
    before = F.sum("n").over(Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1))
    totals = t.groupBy(*keys, "__block").agg(F.count("*").alias("n")).select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__block").alias("__k_block"), F.coalesce(before, F.lit(0)).alias("__before"))
    own = F.row_number().over(Window.partitionBy(*keys, "__block").orderBy(time, *tie))
    same = F.col("__block") == F.col("__k_block")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    return t.withColumn("__own", own).join(totals, same).withColumn(out, F.col("__before") + F.col("__own")).drop("__block", "__k_block", "__before", "__own", *[f"__k_{k}" for k in keys])


def chunked(df: DataFrame, reach: int, work: Callable[[DataFrame], DataFrame], rows: int = CHUNK_ROWS) -> DataFrame:
    """work(df) chunk by chunk: its windows partition by (symbol, __chunk) and look back `reach` rows at most. df: numbered."""
    rows = max(rows, reach)
    i = F.col("__rn") - 1
    here = F.floor(i / rows)
    own = F.when(i % rows >= rows - reach, F.array(here, here + 1)).otherwise(F.array(here))
    done = work(df.withColumn("__chunk", F.explode(own)))
    return done.where(F.floor((F.col("__rn") - 1) / rows) == F.col("__chunk")).drop("__chunk")
