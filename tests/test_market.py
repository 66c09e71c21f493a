from datetime import date, datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.functions import calendar
from barloom.operators import clean, gaps, lineage, recurrence, resample, sessions
from barloom.plans import registry


def frame(spark, rows, names="symbol string, time timestamp_ntz, open double, high double, low double, close double, tick_volume long, real_volume long, spread double"):
    return spark.createDataFrame(rows, names)


def series(spark, times, closes):
    return frame(spark, [("S", t, c, c + 1, c - 1, c, 1, 1, 0.0) for t, c in zip(times, closes, strict=True)])


def test_calendar():
    assert calendar.expected_bars(date(2024, 11, 27)) == 53
    assert calendar.expected_bars(date(2024, 7, 4)) == 0
    assert calendar.expected_bars(date(2024, 7, 5)) == 78
    assert date(2024, 3, 29) in calendar.us_holidays(2024)
    assert calendar.easter(2025) == date(2025, 4, 20)
    assert date(2024, 6, 19) in calendar.us_holidays(2024) and date(2021, 6, 18) not in calendar.us_holidays(2021)


def test_gap_edges(spark):
    t = datetime(2024, 1, 3, 15, 0)
    b = series(spark, [t, t + timedelta(minutes=7), t + timedelta(minutes=14, seconds=1), t + timedelta(minutes=44, seconds=1), t + timedelta(minutes=79, seconds=1)], [1.0] * 5)
    got = {(r["gap_minutes"], r["gap_type"]) for r in gaps.detect_gaps(b).collect()}
    assert got == {(7, "imputable"), (30, "imputable"), (35, "not_imputable")}


def test_hours_across_daylight_saving(spark):
    rows = [(datetime(2024, 3, 8, 14, 30),), (datetime(2024, 3, 11, 13, 30),), (datetime(2024, 3, 11, 13, 29),), (datetime(2024, 3, 8, 21, 0),), (datetime(2024, 3, 8, 21, 0, 1),)]
    got = [r["o"] for r in spark.createDataFrame(rows, "time timestamp_ntz").select(sessions.is_market_open().alias("o")).collect()]
    assert got == [True, True, False, True, False]


def test_forex_week(spark):
    rows = [(datetime(2024, 1, 5, 22, 0),), (datetime(2024, 1, 7, 21, 59),), (datetime(2024, 1, 7, 22, 0),)]
    assert [r["o"] for r in spark.createDataFrame(rows, "time timestamp_ntz").select(sessions.is_forex_open().alias("o")).collect()] == [False, False, True]


@pytest.mark.parametrize("span", [9, 200])
def test_scan_equals_sequential(spark, span):
    x = [50 + (i * 7919 % 101) / 7 for i in range(1500)]
    b = series(spark, [datetime(2024, 1, 1) + timedelta(minutes=5 * i) for i in range(1500)], x)
    got = [r["e"] for r in recurrence.ema(recurrence.numbered(b), "close", span, "e").orderBy("time").collect()]
    want = pd.Series(x).ewm(span=span, adjust=False).mean().tolist()
    assert max(abs(a - w) for a, w in zip(got, want, strict=True)) < 1e-9


def test_bridge_without_noise_is_linear(spark):
    t = datetime(2024, 1, 3, 15, 0)
    got = gaps.bridge_fill(series(spark, [t, t + timedelta(minutes=20)], [10.0, 14.0])).orderBy("time").collect()
    assert [r["close"] for r in got] == pytest.approx([11.0, 12.0, 13.0])
    assert all(r["high"] >= r["close"] >= r["low"] for r in got)


def test_noise_repeats(spark):
    t = datetime(2024, 1, 3, 15, 0)
    f = gaps.bridge_fill(series(spark, [t, t + timedelta(minutes=20)], [10.0, 14.0]), noise=0.001)
    assert f.orderBy("time").collect() == f.orderBy("time").collect()


def test_streaks(spark):
    o = ["I", "I", "N", "I", "I", "I"]
    rows = [("S", datetime(2024, 1, 1, 0, 5 * i), "M5_IMPUTADO_SIMPLE" if x == "I" else "M5_NATIVO") for i, x in enumerate(o)]
    got = gaps.synthetic_streaks(spark.createDataFrame(rows, "symbol string, time timestamp_ntz, data_origin string")).collect()
    assert [r["length"] for r in got] == [3]


def test_priority_and_dedupe(spark):
    rows = [("S", datetime(2024, 1, 1), "H1", 1), ("S", datetime(2024, 1, 1), "M5", 2), ("S", datetime(2024, 1, 1), "odd", 3)]
    df = spark.createDataFrame(rows, "symbol string, time timestamp_ntz, source_timeframe string, seq long")
    assert [r["source_timeframe"] for r in resample.prioritize(df).collect()] == ["M5"]
    assert [r["seq"] for r in resample.dedupe(df, "last").collect()] == [3]


def test_lineage_catalog(spark):
    df = spark.createDataFrame([("native", "M5"), ("aggregated", "M5"), ("aggregated", "M30"), ("native", "weird")], "capture_method string, source_timeframe string")
    assert [r["data_origin"] for r in lineage.assign(df).collect()] == ["M5_NATIVO", "M5_NATIVO", "M5_AGREGADO_M30", "DESCONOCIDO"]


def test_interpolation_edges(spark):
    v = [None, 1.0, None, None, 4.0, None]
    df = spark.createDataFrame([("S", datetime(2024, 1, 1, i), x) for i, x in enumerate(v)], "symbol string, time timestamp_ntz, v double")
    assert [r["v"] for r in clean.interpolate(df, "v").orderBy("time").collect()] == [1.0, 1.0, 2.0, 3.0, 4.0, 4.0]


def test_splits_are_disjoint_and_ordered(spark):
    b = series(spark, [datetime(2024, 1, 1) + timedelta(hours=i) for i in range(100)], [1.0] * 100)
    s = clean.split_walk_forward(b, 3).groupBy("split_id").agg(F.max(F.when(F.col("role") == "train", F.col("time"))).alias("a"), F.min(F.when(F.col("role") == "validation", F.col("time"))).alias("b")).collect()
    assert len(s) == 3 and all(r["a"] < r["b"] for r in s)


def test_empty(spark):
    b = frame(spark, [])
    assert gaps.detect_gaps(b).count() == 0 and sessions.filter_market_hours(b).count() == 0


def test_registry_has_sql_of_the_same_columns():
    assert set(registry.oracle_sql()) <= set(registry.queries())
