"""Exchange calendar: holidays by rule, early closes, expected bars. Small driver-side tables, one row a day."""

from __future__ import annotations

from datetime import date, timedelta

from dateutil.easter import easter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import EARLY_CLOSE_BARS, MARKETS, SUNDAY_FX_BARS


def nth_weekday(year: int, month: int, weekday: int, n: int) -> date:
    """The n-th weekday (Monday 0) of a month; n = -1: the last."""
    if n > 0:
        first = date(year, month, 1)
        return first + timedelta(days=(weekday - first.weekday()) % 7 + 7 * (n - 1))
    last = date(year + month // 12, month % 12 + 1, 1) - timedelta(days=1)
    return last - timedelta(days=(last.weekday() - weekday) % 7)


def observed(day: date) -> date:
    """Saturday moves to Friday, Sunday to Monday."""
    return day + timedelta(days={5: -1, 6: 1}.get(day.weekday(), 0))


def us_holidays(year: int) -> set[date]:
    fixed = [date(year, 1, 1), *([date(year, 6, 19)] if year >= 2022 else []), date(year, 7, 4), date(year, 12, 25)]
    moving = [nth_weekday(year, 1, 0, 3), nth_weekday(year, 2, 0, 3), easter(year) - timedelta(days=2), nth_weekday(year, 5, 0, -1), nth_weekday(year, 9, 0, 1), nth_weekday(year, 11, 3, 4)]
    return {observed(d) for d in fixed} | set(moving)


def good_fridays(first: int = 1900, last: int = 2099) -> list[int]:
    """As days since 1970."""
    return [(easter(y) - timedelta(days=2) - date(1970, 1, 1)).days for y in range(first, last + 1)]


def early_closes(year: int) -> set[date]:
    """The day before Thanksgiving, Christmas Eve on weekdays, July 3 if July 4 is a Saturday."""
    out = {nth_weekday(year, 11, 3, 4) - timedelta(days=1)}
    if date(year, 12, 24).weekday() < 5:
        out.add(date(year, 12, 24))
    if date(year, 7, 4).weekday() == 5:
        out.add(date(year, 7, 3))
    return out


def expected_bars(day: date, market: str = "US500") -> int:
    if market == "US500":
        return 0 if day.weekday() > 4 or day in us_holidays(day.year) else EARLY_CLOSE_BARS if day in early_closes(day.year) else MARKETS[market]["bars"]
    return {5: 0, 6: SUNDAY_FX_BARS}.get(day.weekday(), MARKETS[market]["bars"])


def calendar_table(spark: SparkSession, first: int = 2020, last: int = 2025, market: str = "US500") -> DataFrame:
    """(date, is_holiday, early_close, expected_bars): bounded by the years asked for, so it may be broadcast."""
    day, rows = date(first, 1, 1), []
    while day.year <= last:
        rows.append((day, day in us_holidays(day.year), day in early_closes(day.year), expected_bars(day, market)))
        day += timedelta(days=1)
    return spark.createDataFrame(rows, "date date, is_holiday boolean, early_close boolean, expected_bars int")


def holiday_list(first: int = 1970, last: int = 2069) -> list[date]:
    """A day that a holiday of the next year is moved to is none: the exchange trades on it."""
    return sorted(d for y in range(first, last + 1) for d in us_holidays(y) if d.year == y)


def holiday_rows(bars: DataFrame, first: int = 1970, last: int = 2069) -> DataFrame:
    """Rows on each holiday: there should be none."""
    return bars.where(F.to_date("time").isin(holiday_list(first, last))).groupBy(F.to_date("time").alias("date")).agg(F.count("*").alias("n"))


# A list of holidays kept for comparison; it lacks Juneteenth and counts 2023-01-02 and others by its own rule.
LISTED_HOLIDAYS = (
    "2020-01-01 2020-01-20 2020-02-17 2020-04-10 2020-05-25 2020-07-03 2020-09-07 2020-11-26 2020-12-25 2021-01-01 2021-01-18 2021-02-15 2021-04-02 2021-05-31 2021-07-05 2021-09-06 2021-11-25 2021-12-24 "
    "2022-01-17 2022-02-21 2022-04-15 2022-05-30 2022-07-04 2022-09-05 2022-11-24 2022-12-26 2023-01-02 2023-01-16 2023-02-20 2023-04-07 2023-05-29 2023-07-04 2023-09-04 2023-11-23 2023-12-25 "
    "2024-01-01 2024-01-15 2024-02-19 2024-03-29 2024-05-27 2024-07-04 2024-09-02 2024-11-28 2024-12-25 2025-01-01 2025-01-20 2025-02-17 2025-04-18 2025-05-26 2025-07-04 2025-09-01 2025-11-27 2025-12-25"
).split()


def holiday_sources(spark: SparkSession, first: int = 2020, last: int = 2025) -> DataFrame:
    """(date, by_rule, listed): every day that the rules or the list take for a holiday."""
    rules, listed = set(holiday_list(first, last)), {date.fromisoformat(d) for d in LISTED_HOLIDAYS}
    return spark.createDataFrame([(d, d in rules, d in listed) for d in sorted(rules | listed)], "date date, by_rule boolean, listed boolean")


def span_calendar(bars: DataFrame, market: str = "US500") -> DataFrame:
    """The calendar of the years that the bars span: one small aggregate tells which."""
    first, last = bars.agg(F.min(F.year("time")), F.max(F.year("time"))).first()
    return calendar_table(bars.sparkSession, first or 2020, last or 2020, market)
