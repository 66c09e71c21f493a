"""Reports and the two pipelines: capture (ticks to featured bars) and validate (cleaned, scaled, split)."""

from __future__ import annotations

import json
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lineage_cut import materialize
from ..operators import clean, features, gaps, lineage, preprocess, quality, resample, sessions


def rows(df: DataFrame) -> list[dict]:
    """Rows of a small aggregate."""
    return [r.asDict(recursive=True) for r in df.collect()]


def to_json(report: dict) -> str:
    return json.dumps(report, default=lambda x: x.isoformat() if isinstance(x, (date, datetime)) else str(x), indent=1, sort_keys=True)


def markdown(report: dict) -> str:
    out = []
    for title, table in report.items():
        out.append(f"## {title}\n")
        if table:
            names = list(table[0])
            out += ["| " + " | ".join(names) + " |", "|" + "---|" * len(names), *["| " + " | ".join(str(r[c]) for c in names) + " |" for r in table]]
        out.append("")
    return "\n".join(out)


def sparkline(values: list[float]) -> str:
    low, high = min(values, default=0), max(values, default=0)
    return "".join("▁▂▃▄▅▆▇█"[int(7 * (v - low) / (high - low)) if high > low else 0] for v in values)


def quality_report(bars: DataFrame, per_day: int = 78) -> dict:
    gap = gaps.detect_gaps(bars)
    return {
        "summary": rows(bars.groupBy("symbol").agg(F.count("*").alias("n"), F.min("time").alias("first"), F.max("time").alias("last"))),
        "gap_analysis": rows(gaps.gap_buckets(gap)),
        "data_origin_analysis": rows(lineage.breakdown(bars, ("symbol",))),
        "yearly": rows(quality.period_stats(bars, "year")),
        "score": rows(quality.checklist_score(bars)),
    }


def capture(ticks: DataFrame, market: str = "US500") -> DataFrame:
    """Ticks to bars, market hours, imputation of short gaps, features, lineage. The bars are checkpointed, since gaps read them twice."""
    bars = sessions.filter_market_hours(resample.ticks_to_bars(ticks), market).withColumn("quality_score", F.lit(0.98))
    bars = materialize(bars)
    filled = bars.unionByName(gaps.bridge_fill(bars, market=market, noise=0.001))
    return features.all_features(filled)


def validate(bars: DataFrame, scale: tuple[str, ...] = ()) -> DataFrame:
    """Repair, clean by category, scale, label the fixed-year split."""
    t = preprocess.full_clean(clean.repair_bars(bars))
    if scale:
        t = clean.Scaler("robust", list(scale)).fit(t).transform(t)
    return clean.split_years(t)


def migrate(bars: DataFrame) -> DataFrame:
    """Rows in hours with granular origin and score."""
    return lineage.granular(sessions.filter_market_hours(bars))
