"""Whole steps, fixtures with planted faults, sources, sinks and runs."""

import json
import random
from datetime import date, datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.functions import calendar
from barloom.operators import analysis, blocks, capture, clean, features, gaps, preprocess, quality, recurrence, resample
from barloom.plans import pipeline, reports
from barloom.sources import tables
from barloom.streaming import bars as streaming

NAMES = "symbol string, time timestamp_ntz, open double, high double, low double, close double, tick_volume long, real_volume long, spread double, data_origin string, quality_score double"


def make(spark, n=300, symbols=("A", "B"), start=datetime(2024, 1, 3, 14, 30), seed=42):
    r, rows = random.Random(seed), []
    for s in symbols:
        for i in range(n):
            c = 100 + r.gauss(0, 1)
            rows.append((s, start + timedelta(minutes=5 * i), c, c + 1, c - 1, c + r.gauss(0, 0.3), r.randint(100, 1000), r.randint(1, 9), 0.2, "M5_IMPUTADO_SIMPLE" if i % 9 == 0 else "M5_NATIVO", 1.0))
    return spark.createDataFrame(rows, NAMES)


def test_long_runs_of_nulls_are_filled_in_linear_time(spark):
    n = 60_000
    df = spark.range(n).select(F.lit("S").alias("symbol"), F.col("id").alias("time"), F.when(F.col("id").isin(10, n - 10), F.col("id").cast("double")).alias("v"))
    got = clean.interpolate(df, "v").agg(F.sum(F.abs(F.col("v") - F.least(F.greatest("time", F.lit(10)), F.lit(n - 10))))).first()[0]
    assert got < 1e-3
    assert df.select(clean.fill_forward("v").alias("v")).agg(F.min("v"), F.max("v")).first()[:] == (10.0, float(n - 10))


@pytest.mark.parametrize("rows", [7, 1000])
def test_numbers_and_chunks_equal_a_whole_symbol(spark, rows):
    b = make(spark, 500, start=datetime(2023, 12, 30))
    t = blocks.numbered(b)
    want = {(r["symbol"], r["time"]): r["n"] for r in b.selectExpr("symbol", "time", "row_number() OVER (PARTITION BY symbol ORDER BY time) AS n").collect()}
    assert {(r["symbol"], r["time"]): r["__rn"] for r in t.collect()} == want
    look = lambda keys: F.sum("close").over(__import__("pyspark.sql", fromlist=["Window"]).Window.partitionBy(*keys).orderBy("time").rowsBetween(-5, 0))
    got = blocks.chunked(t, 5, lambda c: c.withColumn("s", look(("symbol", "__chunk"))), rows)
    assert sorted((r["symbol"], r["time"], round(r["s"], 6)) for r in got.collect()) == sorted((r["symbol"], r["time"], round(r["s"], 6)) for r in b.withColumn("s", look(("symbol",))).collect())


def test_all_features_in_small_chunks(spark, monkeypatch):
    b = make(spark, 700)
    names = ["sma_200_slope", "bb_position_30_3", "stoch_d_21", "volatility_30", "ema_200", "rsi_28", "macd_signal", "cumulative_return_week", "price_to_vwap"]
    value = lambda df: {(r["symbol"], r["time"]): [None if r[c] is None else round(r[c], 6) for c in names] for c in [0] for r in df.collect()}
    want = value(features.all_features(b))
    monkeypatch.setattr(blocks, "CHUNK_ROWS", 1)
    monkeypatch.setattr(blocks.chunked, "__defaults__", (1,))
    assert value(features.all_features(b)) == want and len(want) == 1400
    rsi = pd.Series([r["close"] for r in b.where("symbol = 'A'").orderBy("time").collect()]).diff()
    gain, loss = rsi.clip(lower=0).ewm(alpha=1 / 14, adjust=False).mean(), (-rsi).clip(lower=0).ewm(alpha=1 / 14, adjust=False).mean()
    last = recurrence.rsi_wilder(b.where("symbol = 'A'")).orderBy(F.desc("time")).first()["rsi_14"]
    assert abs(last - (100 - 100 / (1 + gain.iloc[-1] / loss.iloc[-1]))) < 1e-6


def test_flat_prices_and_no_volume(spark):
    t = datetime(2024, 1, 3)
    b = spark.createDataFrame([("S", t + timedelta(minutes=5 * i), 5.0, 5.0, 5.0, 5.0, 0, 0, 0.0, "M5_NATIVO", 1.0) for i in range(40)], NAMES)
    r = features.all_features(b).orderBy(F.desc("time")).first()
    assert r["rsi_14"] == 100 and r["bb_position_20_2"] is None and r["stoch_k_14"] is None and r["vwap"] is None and r["volume_ratio"] is None
    assert quality.price_continuity(b).first()["autocorrelation"] is None


def test_outlier_fixture(spark):
    b = make(spark, 100, ("S",)).withColumn("close", F.when(F.row_number().over(__import__("pyspark.sql", fromlist=["Window"]).Window.partitionBy("symbol").orderBy("time")) == 1, 1e6).otherwise(F.col("close")))
    r = analysis.capture_integrity(b).first()
    assert r["bad_bars"] >= 1 and r["wide_range"] is False or r["bad_bars"] >= 1 and not r["valid"]
    assert {x["column_name"]: x["n_outliers"] for x in clean.iqr_outliers(b, ["close"]).collect()}["close"] >= 1


def test_cleaning_leaves_no_nulls_and_spares_the_rest(spark):
    b = make(spark).withColumns({"log_return": F.when(F.minute("time") != 0, 0.01), "doji": F.lit(None).cast("int"), "note": F.lit("x")})
    t = preprocess.clean_nulls(b.withColumn("close", F.when(F.minute("time") != 10, F.col("close"))))
    assert t.where("close IS NULL OR log_return IS NULL OR doji IS NULL").count() == 0 and t.columns == b.columns
    assert preprocess.full_clean(b.unionByName(b)).count() == b.count()
    empty = b.limit(0)
    assert preprocess.full_clean(empty).count() == 0 and preprocess.clean_nulls(empty).count() == 0
    kept = preprocess.handle_outliers(b.withColumn("log_return", F.when(F.minute("time") != 0, 0.01)))
    assert kept.where("log_return IS NULL").count() == b.where(F.minute("time") == 0).count()


def test_selection_reports_every_step(spark):
    b = make(spark).withColumns({"data_flag": F.lit("real"), "ema_21": F.col("close") * 2})
    table, info = preprocess.selection(b, target="close")
    assert "ema_21" in info["correlated"] and "spread" in info["constant"] and info["selected"][-2:] == ["time", "data_flag"]
    assert table.columns == info["selected"] and set(info["importance"]) <= set(info["selected"])


def test_params_round_trip(spark, tmp_path):
    s = clean.Scaler("minmax", ["close"]).fit(make(spark))
    preprocess.save_params(s.params, str(tmp_path / "p.json"))
    again = clean.Scaler("minmax", ["close"])
    again.params = preprocess.load_params(str(tmp_path / "p.json"))
    assert again.params == s.params


def test_calendar_rules():
    assert {date(2019, 4, 19), date(2024, 3, 29), date(2038, 4, 23)} <= set(calendar.holiday_list())
    assert date(2021, 12, 31) not in calendar.holiday_list() and date(1995, 7, 4) in calendar.holiday_list()
    missing = set(calendar.LISTED_HOLIDAYS) - {str(d) for d in calendar.holiday_list(2020, 2025)}
    assert str(date(2024, 6, 19)) not in calendar.LISTED_HOLIDAYS and len(missing) < 6


def test_holiday_expression_equals_the_rules(spark):
    from barloom.operators.sessions import is_us_holiday

    days = spark.sql("SELECT explode(sequence(DATE'1970-01-01', DATE'2069-12-31')) AS d")
    assert sorted(r["d"] for r in days.where(is_us_holiday(F.col("d"))).collect()) == calendar.holiday_list(1970, 2069)


def test_coverage_by_the_calendar(spark):
    t = datetime(2024, 11, 27, 9, 30)
    b = make(spark, 53, ("S",), t)
    r = analysis.calendar_coverage(b, calendar.span_calendar(b)).collect()
    assert [(x["date"], x["expected"], x["actual"], x["grade"]) for x in r] == [(date(2024, 11, 27), 53, 53, "A")]


@pytest.mark.parametrize("first", range(1, 15))
def test_business_days(spark, first):
    a = date(2024, 4, first)
    rows = [(a, a + timedelta(days=k)) for k in range(20)]
    got = [r["n"] for r in spark.createDataFrame(rows, "a date, b date").select("b", analysis.business_days(F.col("a"), F.col("b")).alias("n")).orderBy("b").collect()]
    assert got == [sum((a + timedelta(days=i)).weekday() < 5 for i in range(k + 1)) for k in range(20)]


def test_gap_events_fixture(spark):
    e = spark.createDataFrame([(15, "brownian_bridge", 0.5), (30, "not_imputed", None), (60, "ignored", None), (61, None, None)], "gap_minutes int, filled_by string, variance double")
    got = {r["size"]: (r["n"], r["filled"], r["variance"]) for r in analysis.gap_analysis(e).collect()}
    assert got == {"medium (11-30 min)": (2, 2, 0.5), "large (31-60 min)": (1, 1, 0.0), "very large (>60 min)": (1, 0, 0.0)}


def test_walks_end_where_the_gap_ends(spark):
    t = datetime(2024, 1, 3, 15, 0)
    rows = [("S", t, 10.0), ("S", t + timedelta(minutes=55), 21.0), ("S", t + timedelta(minutes=155), 41.0)]
    b = spark.createDataFrame([(s, x, c, c, c, c, 5, 5, 0.0, "M5_NATIVO", 1.0) for s, x, c in rows], NAMES)
    got = gaps.random_walk_fill(b, max_minutes=240).orderBy("time").collect()
    short, long = got[:10], got[10:]
    assert [round(r["close"], 6) for r in short] == [11.0 + i for i in range(10)] and all(r["tick_volume"] == 0 and r["data_origin"].endswith("INTERPOLADO") for r in short)
    assert len(long) == 19 and abs(long[-1]["close"] - 41) < 1e-6 and all(100 <= r["tick_volume"] < 1000 and r["high"] >= r["close"] >= r["low"] for r in long)


def test_ticks_fixture(spark):
    t = datetime(2024, 1, 1)
    ticks = spark.createDataFrame([("S", t + timedelta(minutes=i), 1.0 + i, 1.2 + i, 1, i) for i in range(100)], "symbol string, time timestamp_ntz, bid double, ask double, volume long, seq long")
    b = resample.ticks_to_bars(resample.mid_price(ticks)).orderBy("time").collect()
    assert len(b) == 20 and b[0]["open"] == pytest.approx(1.1) and b[0]["spread"] == pytest.approx(0.2)


def test_sources_and_fallback(spark):
    b = make(spark, 20, ("S",))
    second = b.withColumn("time", F.col("time") + F.expr("INTERVAL 50 MINUTES")).withColumn("close", F.lit(-1.0))
    got = capture.fallback(b, second)
    assert got.count() == 30 and got.where("close = -1").count() == 10
    odd = b.select("time", F.col("close").cast("string").alias("close"), F.col("open").alias("return"), F.col("time").alias("time"))
    assert capture.conform_types(odd).columns == ["time", "close", "returns"]
    wide = capture.downcast(b.withColumns({"hour": F.hour("time").cast("long"), "is_morning": F.lit(1).cast("long")}))
    kinds = dict(wide.dtypes)
    assert (kinds["close"], kinds["tick_volume"], kinds["hour"], kinds["is_morning"]) == ("float", "int", "tinyint", "smallint")
    assert capture.save_check(b).first()[:] == (20, 0, 0, 2, 0)
    assert capture.feature_columns(b.withColumn("rsi_14", F.lit(1.0))) == ["rsi_14"]


def test_files(spark, tmp_path):
    import pyarrow.feather

    b = make(spark, 30)
    pyarrow.feather.write_feather(b.toArrow(), str(tmp_path / "b.feather"), compression="zstd")
    assert sorted(map(str, tables.read_bars(spark, str(tmp_path / "b.feather")).collect())) == sorted(map(str, b.collect()))
    b.coalesce(1).write.json(str(tmp_path / "b.json"))
    assert tables.read_bars(spark, str(tmp_path / "b.json")).count() == 60
    tables.write_bars(b, str(tmp_path / "out"))
    assert tables.read_bars(spark, str(tmp_path / "out.csv")).count() == 60
    sums = tables.checksums(spark, str(tmp_path / "out.parquet")).collect()
    assert sums and all(len(r["sha256"]) == 64 and r["length"] > 0 for r in sums)
    assert tables.check_file(str(tmp_path / "none.csv")) == ["missing"]
    (tmp_path / "bad.csv").write_text("no header")
    (tmp_path / "empty.txt").write_text("")
    assert tables.check_file(str(tmp_path / "bad.csv")) == ["header"] and tables.check_file(str(tmp_path / "empty.txt")) == ["extension", "empty"]
    tables.write_splits(clean.split_ratio(b, 0.8), str(tmp_path / "splits"))
    info = spark.read.json(str(tmp_path / "splits_split_info")).collect()
    assert sum(r["n"] for r in info) == 60
    assert capture.file_report(spark, str(tmp_path / "out.parquet")).agg(F.sum("n")).first()[0] == 60


def test_stream_equals_batch(spark, tmp_path):
    t = datetime(2024, 1, 1)
    rows = [("S", t + timedelta(minutes=i), float(i), 1, i) for i in range(60)]
    ticks = spark.createDataFrame(rows, "symbol string, time timestamp, price double, volume long, seq long")
    ticks.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(ticks.schema).parquet(str(tmp_path / "in"))
    q = streaming.stream_bars(stream, late="0 minutes").writeStream.format("memory").queryName("bars_stream").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted((r["time"], r["open"], r["close"], r["tick_volume"]) for r in spark.table("bars_stream").collect())
    want = sorted((r["time"], r["open"], r["close"], r["tick_volume"]) for r in resample.ticks_to_bars(ticks.withColumn("time", F.col("time").cast("timestamp_ntz"))).collect())
    assert got and got == want[: len(got)] and len(got) >= 11


def test_whole_run(spark, tmp_path):
    t = datetime(2024, 1, 3, 14, 30)
    ticks = spark.createDataFrame([("S", t + timedelta(minutes=i), 100.0 + i % 7, 1, i) for i in range(300) if not 100 <= i < 120], "symbol string, time timestamp_ntz, price double, volume long, seq long")
    config = pipeline.Config(start="2024", end="2024", train=(2024, 2024), validation=(2025, 2025), test=(2026, 2026))
    report = pipeline.run(spark, ticks, str(tmp_path / "out"), config)
    assert {"score", "checks", "market", "run", "cleaning"} <= set(report) and report["score"][0]["symbol"] == "S"
    assert pipeline.export(report, str(tmp_path / "report")) == ["executive.md", "report.json", "report.md"]
    assert json.loads((tmp_path / "report" / "report.json").read_text())["score"]
    again = pipeline.run(spark, ticks, str(tmp_path / "out"), config, skip_capture=True, skip_validate=True)
    assert set(again) == {"config", "run"}
    b = spark.read.parquet(str(tmp_path / "out" / "bars"))
    assert b.where("data_origin LIKE '%IMPUTADO%'").count() == 4 and "S: 60 rows" in pipeline.text_summary(b)


def test_config_and_environment(tmp_path):
    assert pipeline.Config().wrong() == [] and pipeline.environment() == []
    bad = pipeline.Config(start="2025", end="2020", market="X", scaler="y", validation=(2022, 2021), max_gap_minutes=0, formats=("xls",))
    assert len(bad.wrong()) == 6 and pipeline.Config(start="soon").wrong()
    bad.save(str(tmp_path / "c.json"))
    assert pipeline.Config.load(str(tmp_path / "c.json")) == bad
    assert pipeline.parse_date("2024", end=True) == date(2024, 12, 31) and pipeline.parse_date("2024-02-03") == date(2024, 2, 3)
    assert pipeline.main(["--check"]) == 0


def test_capture_resumes(spark, tmp_path):
    ticks = spark.createDataFrame([("S", datetime(y, 3, 4, 15, i), 1.0, 1, i) for y in (2023, 2024) for i in range(30)], "symbol string, time timestamp_ntz, price double, volume long, seq long")
    config = pipeline.Config(start="2023", end="2024")
    assert pipeline.capture_years(ticks, config, str(tmp_path / "b"), str(tmp_path / "c.json")) == [2023, 2024]
    assert pipeline.capture_years(ticks, config, str(tmp_path / "b"), str(tmp_path / "c.json")) == []


def test_markdown():
    assert "| a |" in reports.markdown({"t": [{"a": 1}], "e": []}) and reports.sparkline([1, 2]) == "▁█"
