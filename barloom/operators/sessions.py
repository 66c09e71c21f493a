"""Market-hours predicates and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import good_fridays
from ..functions.catalog import MARKETS

ZONE = "America/New_York"


def local(time: Column | str = "time", zone: str = ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(time) if isinstance(time, str) else time)


def seconds_of_day(t: Column) -> Column:
    return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def is_us_holiday(day: Column) -> Column:
    """The rules of `calendar.us_holidays` as an expression: any year, no table; Good Fridays of 1900 to 2099 are listed."""
    month, number, week = F.month(day), F.dayofmonth(day), F.weekday(day)
    at = lambda m, n: (month == m) & (number == n)
    # A fixed day on a Saturday moves to Friday, on a Sunday to Monday; New Year's Day never moves into the old year.
    fixed = lambda m, n: at(m, n) & (week < 5) | at(m, n - 1) & (week == 4) | at(m, n + 1) & (week == 0)
    nth = lambda m, w, lo, hi: (month == m) & (week == w) & number.between(lo, hi)
    moving = nth(1, 0, 15, 21) | nth(2, 0, 15, 21) | nth(5, 0, 25, 31) | nth(9, 0, 1, 7) | nth(11, 3, 22, 28)
    days = fixed(1, 1) | (F.year(day) >= 2022) & fixed(6, 19) | fixed(7, 4) | fixed(12, 25) | moving
    return F.when(month.isin(3, 4), F.array_contains(F.lit(good_fridays()), F.unix_date(day))).otherwise(days)


def is_market_open(time: Column | str = "time", market: str = "US500", holidays: bool = True) -> Column:
    """Weekday, not a holiday, open to close inclusive, in the market's zone."""
    m, t = MARKETS[market], local(time, MARKETS[market]["zone"])
    ok = (F.weekday(t) < 5) & seconds_of_day(t).between(m["open"], m["close"])
    return ok & ~is_us_holiday(F.to_date(t)) if holidays else ok


def is_forex_open(time: Column | str = "time") -> Column:
    """Closed from Friday 22:00 to Sunday 22:00 UTC."""
    t = F.col(time) if isinstance(time, str) else time
    day, hour = F.weekday(t), F.hour(t)
    return ~(((day == 4) & (hour >= 22)) | (day == 5) | ((day == 6) & (hour < 22)))


def gap_in_hours(start: Column, end: Column, market: str = "US500") -> Column:
    """Both ends on weekdays within hours; not necessarily the same day."""
    def inside(x: Column) -> Column:
        t = local(x)
        hour = F.hour(t) + F.minute(t) / 60.0
        return (F.weekday(t) < 5) & (hour.between(9.5, 16.0) if market == "US500" else F.hour(t).between(8, 17))

    return inside(start) & inside(end)


def checklist_hours(time: Column | str = "time") -> Column:
    """Hour 9 to 15, or exactly 16:00, on the stored clock."""
    t = F.col(time) if isinstance(time, str) else time
    return F.hour(t).between(9, 15) | ((F.hour(t) == 16) & (F.minute(t) == 0))


def filter_market_hours(bars: DataFrame, market: str = "US500") -> DataFrame:
    return bars.where(is_forex_open() if market == "FX" else is_market_open(market=market))


def market_hours_stats(bars: DataFrame, market: str = "US500") -> DataFrame:
    opened = F.count_if(is_market_open(market=market))
    return bars.groupBy("symbol").agg(F.count("*").alias("total"), opened.alias("kept"), (F.count("*") - opened).alias("removed"), F.round(100.0 * opened / F.count("*"), 6).alias("pct_kept"))


def non_compliant(bars: DataFrame, n: int = 5) -> DataFrame:
    """The first n rows outside of hours (a report of examples)."""
    return bars.where(~is_market_open()).orderBy("time", "symbol").limit(n)


def time_distribution(bars: DataFrame) -> DataFrame:
    t = local()
    return bars.groupBy("symbol", F.hour(t).alias("hour"), F.weekday(t).alias("weekday")).agg(F.count("*").alias("n"))


def minutes_since_previous(partition: tuple[str, ...] = ("symbol",)) -> Column:
    before = F.lag("time").over(Window.partitionBy(*partition).orderBy("time"))
    return F.timestamp_diff("MICROSECOND", before, F.col("time")) / 60e6


def interval_stats(bars: DataFrame) -> DataFrame:
    d = bars.select("symbol", minutes_since_previous().alias("d"))
    odd = F.count_if(F.abs(F.col("d") - 5) > 1)
    return d.groupBy("symbol").agg(
        F.round(F.avg("d"), 6).alias("mean_min"), F.round(F.percentile("d", 0.5), 6).alias("median_min"), F.round(F.min("d"), 6).alias("min_min"), F.round(F.max("d"), 6).alias("max_min"), F.round(F.stddev_samp("d"), 6).alias("std_min"),
        odd.alias("irregular"), (F.avg("d") > 7.5).alias("too_sparse"), (odd > 0.1 * F.count("d")).alias("too_irregular"),
    )
