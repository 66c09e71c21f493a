"""Whole runs: configuration, capture by year, validation, reports and exports. Also `python -m barloom.plans.pipeline`."""

from __future__ import annotations

import argparse
import json
import platform
import shutil
import subprocess
import sys
import time
from dataclasses import asdict, dataclass, field, fields
from datetime import date, datetime, timezone
from importlib import import_module
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import span_calendar
from ..functions.catalog import DATA_ORIGINS, MARKETS
from ..operators import analysis, clean, features, gaps, lineage, preprocess, quality, resample, sessions
from ..sources.tables import YearCheckpoint, read_bars, write_bars, write_reports
from . import reports


def parse_date(text: str, end: bool = False) -> date:
    """YYYY or YYYY-MM-DD; a year is its first day, or its last."""
    if len(text) == 4 and text.isdigit():
        return date(int(text), 12, 31) if end else date(int(text), 1, 1)
    return date.fromisoformat(text)


@dataclass
class Config:
    symbol: str = "US500"
    start: str = "2020"
    end: str = "2025"
    market: str = "US500"
    scaler: str = "robust"
    train: tuple[int, int] = (2020, 2023)
    validation: tuple[int, int] = (2024, 2024)
    test: tuple[int, int] = (2025, 2025)
    max_gap_minutes: int = 30
    deviations: float = 5.0
    formats: tuple[str, ...] = field(default=("parquet", "csv"))

    def wrong(self) -> list[str]:
        """What can't be run; nothing if the list is empty."""
        out = []
        try:
            if parse_date(self.start) > parse_date(self.end, end=True):
                out.append("start is after end")
        except ValueError:
            out.append("start and end must be YYYY or YYYY-MM-DD")
        if self.market not in MARKETS:
            out.append(f"unknown market {self.market}")
        if self.scaler not in ("robust", "standard", "minmax"):
            out.append(f"unknown scaler {self.scaler}")
        spans = (self.train, self.validation, self.test)
        if any(a > b for a, b in spans) or any(x[1] >= y[0] for x, y in zip(spans, spans[1:])):
            out.append("splits must follow each other")
        if self.max_gap_minutes <= 0 or self.deviations <= 0:
            out.append("limits must be positive")
        if set(self.formats) - {"parquet", "csv"} or not self.formats:
            out.append("formats are parquet and csv")
        return out

    @classmethod
    def load(cls, path: str) -> Config:
        known = {f.name for f in fields(cls)}
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(Path(path).read_text()).items() if k in known})

    def save(self, path: str) -> None:
        Path(path).write_text(json.dumps(asdict(self), indent=1))


def environment(packages: tuple[str, ...] = ("pyspark", "pyarrow", "pandas", "numpy"), least_free_gb: float = 1.0) -> list[str]:
    """What the driver's machine lacks; nothing if the list is empty."""
    out = [] if sys.version_info >= (3, 10) else ["python"]
    for name in packages:
        try:
            import_module(name)
        except ImportError:
            out.append(name)
    if shutil.which("java") is None:
        out.append("java")
    if shutil.disk_usage(".").free < least_free_gb * 1e9:
        out.append("disk")
    return out


def metadata(spark: SparkSession, started: float) -> dict:
    """Versions, machine, revision and duration of a run."""
    try:
        revision = subprocess.run(["git", "rev-parse", "HEAD"], capture_output=True, text=True, timeout=10).stdout.strip() or None
    except (OSError, subprocess.SubprocessError):
        revision = None
    return {"time": datetime.now(timezone.utc).isoformat(), "seconds": round(time.time() - started, 3), "python": platform.python_version(), "spark": spark.version, "system": platform.platform(), "revision": revision, "default_parallelism": spark.sparkContext.defaultParallelism}


# Capture.


def capture_year(ticks: DataFrame, year: int, config: Config) -> DataFrame:
    """Bars of one year, in hours, short gaps filled, each row with its origin. Filters on time reach the scan."""
    own = ticks.where((F.col("time") >= F.lit(f"{year}-01-01").cast("timestamp_ntz")) & (F.col("time") < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")))
    bars = sessions.filter_market_hours(resample.ticks_to_bars(own), config.market).withColumn("quality_score", lineage.score_of())
    return bars.unionByName(gaps.bridge_fill(bars, max_minutes=config.max_gap_minutes, market=config.market, noise=0.001))


def capture_years(ticks: DataFrame, config: Config, out: str, checkpoint: str | None = None) -> list[int]:
    """Each year's bars as Parquet below `out`; years that a checkpoint names as done are skipped. Years are written one by
    one so that a run can be resumed: within one, all executors work."""
    done = YearCheckpoint(checkpoint) if checkpoint else None
    first, last = parse_date(config.start).year, parse_date(config.end, end=True).year
    years = list(range(max(first, done.resume_at(first)) if done else first, last + 1))
    for year in years:
        capture_year(ticks, year, config).write.mode("overwrite").parquet(f"{out}/year={year}")
        if done:
            done.done(year)
    return years


# Validation.


def validations(bars: DataFrame, split: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every validator's table, a row a symbol or less."""
    coverage = analysis.calendar_coverage(bars, span_calendar(bars))
    return {
        "market": analysis.market_checks(bars), "integrity": analysis.integrity_checks(bars), "capture": analysis.capture_integrity(bars), "coverage": analysis.completeness_stats(coverage), "months": analysis.month_completeness(coverage),
        "originality": analysis.originality(bars), "origins": analysis.origin_distribution(bars, tuple(DATA_ORIGINS)), "checks": analysis.reporter_checks(bars), "score": quality.checklist_score(bars, split), "gaps": gaps.gap_buckets(gaps.detect_gaps(bars)),
    }


def summaries(bars: DataFrame) -> dict[str, DataFrame]:
    """The summary tables that a capture leaves beside its bars."""
    gap = gaps.detect_gaps(bars)
    return {"summary": analysis.summary(bars), "yearly": quality.period_stats(bars, "year"), "monthly": quality.period_stats(bars, "month"), "gap_log": gap, "gap_buckets": gaps.gap_buckets(gap), "streaks": gaps.synthetic_streaks(bars), "daily": analysis.daily_analysis(bars), "duplicates": resample.duplicates_report(bars)}


def validate_all(bars: DataFrame, config: Config) -> tuple[DataFrame, DataFrame]:
    """(cleaned and scaled rows with their split, the cleaned rows): scaling is fitted on training rows only."""
    cleaned = preprocess.full_clean(clean.repair_bars(bars), config.deviations)
    split = clean.split_years(cleaned, config.train, config.validation, config.test)
    cols = [c for c in ("tick_volume", "real_volume") if c in split.columns]
    fitted = clean.Scaler(config.scaler, cols).fit(split.where("role = 'train'"))
    usable = all(v is not None for v in fitted.params.values())  # no training rows: nothing to scale by
    return (fitted.transform(split) if usable else split), cleaned


# Reports.


def executive(found: dict[str, list[dict]], config: Config) -> str:
    """A page of Markdown: state, score and advice."""
    lines = [f"# {config.symbol} {config.start} to {config.end}", ""]
    for row in found.get("score", []):
        lines.append(f"- {row['symbol']}: {row['score']} ({row['status']}), {row['n']} rows")
    failed = [r for r in found.get("checks", []) if r["status"] != "PASS"]
    lines += ["", "## Checks that did not pass", ""] + ([f"- {r['check']}: {r['value']} ({r['status']})" for r in failed] or ["None."])
    values = [r["mean"] for r in found.get("coverage", []) if r.get("mean") is not None]
    return "\n".join([*lines, "", f"Completeness: {reports.sparkline(values)}", ""])


def text_summary(bars: DataFrame) -> str:
    """A line a symbol."""
    t = bars.groupBy("symbol").agg(F.count("*").alias("n"), F.min("time").alias("a"), F.max("time").alias("z"), F.round(F.avg("close"), 4).alias("mean"))
    return "\n".join(f"{r['symbol']}: {r['n']} rows, {r['a']} to {r['z']}, mean close {r['mean']}" for r in t.orderBy("symbol").collect())


def merge(*found: dict) -> dict:
    """Several reports in one; later ones win."""
    out: dict = {}
    for f in found:
        out |= f
    return out


def run(spark: SparkSession, ticks: DataFrame, out: str, config: Config | None = None, skip_capture: bool = False, skip_validate: bool = False) -> dict:
    """Capture and validation with all their outputs below `out`, a path that the cluster shares; the merged report."""
    config, started = config or Config(), time.time()
    if wrong := config.wrong():
        raise ValueError("; ".join(wrong))
    report: dict = {"config": [asdict(config)]}
    if not skip_capture:
        capture_years(ticks, config, f"{out}/bars")
    bars = spark.read.parquet(f"{out}/bars").drop("year")
    if not skip_capture:
        write_reports(summaries(bars), f"{out}/summaries")
    if not skip_validate:
        data, cleaned = validate_all(bars, config)
        write_bars(data, f"{out}/validated", config.formats)
        found = {k: reports.rows(v) for k, v in validations(bars, data).items()}
        report = merge(report, found, {"cleaning": reports.rows(preprocess.clean_summary(bars, cleaned))})
    report["run"] = [metadata(spark, started)]
    return report


def export(report: dict, folder: str) -> list[str]:
    """The report as JSON, Markdown and an executive page in a folder of the driver."""
    to = Path(folder)
    to.mkdir(parents=True, exist_ok=True)
    config = Config(**{k: v for k, v in report.get("config", [{}])[0].items()})
    pages = {"report.json": reports.to_json(report), "report.md": reports.markdown(report), "executive.md": executive(report, config)}
    for name, text in pages.items():
        (to / name).write_text(text)
    return sorted(pages)


def with_features(bars: DataFrame) -> DataFrame:
    return features.all_features(bars)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="barloom")
    p.add_argument("ticks", nargs="?", help="Parquet of (symbol, time, price, volume, seq)")
    p.add_argument("out", nargs="?", help="folder that the cluster shares")
    for name in ("symbol", "start", "end", "market"):
        p.add_argument(f"--{name}", default=getattr(Config, name))
    p.add_argument("--config")
    p.add_argument("--skip-capture", action="store_true")
    p.add_argument("--skip-validate", action="store_true")
    p.add_argument("--check", action="store_true", help="check the environment and stop")
    a = p.parse_args(argv)
    if a.check:
        lacks = environment()
        print("ok" if not lacks else "missing: " + ", ".join(lacks))
        return bool(lacks)
    if not (a.ticks and a.out):
        p.error("ticks and out are needed")
    config = Config.load(a.config) if a.config else Config(a.symbol, a.start, a.end, a.market)
    if wrong := config.wrong():
        p.error("; ".join(wrong))
    spark = SparkSession.builder.getOrCreate()
    report = run(spark, read_bars(spark, a.ticks), a.out, config, a.skip_capture, a.skip_validate)
    print(reports.to_json(report))
    return 0


if __name__ == "__main__":
    sys.exit(main())
