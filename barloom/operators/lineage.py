"""Origin and quality score of every row."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.catalog import DATA_ORIGINS, TIMEFRAMES
from .gaps import neighbour_interval
from .sessions import is_market_open


def _map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(values.items())])


def score_of(origin: Column | str = "data_origin") -> Column:
    return F.try_element_at(_map({k: v[0] for k, v in DATA_ORIGINS.items()}), F.col(origin) if isinstance(origin, str) else origin)


def category_of(origin: Column | str = "data_origin") -> Column:
    return F.try_element_at(_map({k: v[1] for k, v in DATA_ORIGINS.items()}), F.col(origin) if isinstance(origin, str) else origin)


def origin_of(method: Column, timeframe: Column) -> Column:
    """Origin by capture method and timeframe; M5 is never an aggregate of itself."""
    native = F.when(timeframe.isin(*TIMEFRAMES), F.concat(timeframe, F.lit("_NATIVO"))).when(F.lower(timeframe) == "ticks", "TICKS_NATIVO").otherwise("DESCONOCIDO")
    aggregated = F.when(timeframe == "M5", "M5_NATIVO").when(timeframe.isin(*TIMEFRAMES), F.concat(F.lit("M5_AGREGADO_"), timeframe)).when(F.lower(timeframe) == "ticks", "M5_AGREGADO_TICKS").otherwise("DESCONOCIDO")
    m = F.lower(method)
    imputed = F.when(m.contains("brownian"), "M5_IMPUTADO_BROWNIAN").when(m.contains("interpol"), "M5_IMPUTADO_INTERPOLADO").when(m.contains("gauss"), "M5_IMPUTADO_GAUSSIANO").otherwise("M5_IMPUTADO_SIMPLE")
    return F.when(m.contains("imput") | m.contains("brownian"), imputed).when(m.contains("aggreg") | m.contains("resampl"), aggregated).when(m.contains("fallback"), "M5_FALLBACK").otherwise(native)


def assign(bars: DataFrame) -> DataFrame:
    return bars.withColumn("data_origin", origin_of(F.col("capture_method"), F.col("source_timeframe"))).withColumn("quality_score", score_of())


def legacy_origin(flag: Column, timeframe: Column) -> Column:
    low = F.lower(flag)
    return (
        F.when(low.contains("imputed_brownian"), "M5_IMPUTADO_BROWNIAN").when(low.contains("imputed_interpol"), "M5_IMPUTADO_INTERPOLADO").when(low.contains("imputed"), "M5_IMPUTADO_SIMPLE")
        .when(low.contains("ticks"), "M5_AGREGADO_TICKS").when(flag.contains("real_m5") | flag.contains("rates"), "M5_NATIVO").when(flag.contains("from_m1") | flag.contains("aggregated"), "M5_AGREGADO_M1")
        .otherwise(F.when(timeframe.isin(*TIMEFRAMES), F.concat(timeframe, F.lit("_NATIVO"))).otherwise("DESCONOCIDO"))
    )


def from_legacy(bars: DataFrame) -> DataFrame:
    return bars.withColumn("data_origin", legacy_origin(F.col("data_flag"), F.col("source_timeframe"))).withColumn("quality_score", score_of())


def granular(bars: DataFrame, market_hours: bool = True) -> DataFrame:
    """Origin by the mean interval to the neighbours: nearest timeframe, first wins ties; imputed rows keep theirs."""
    t = neighbour_interval(bars)
    choices = F.array(*[F.struct(F.abs(F.col("mean_interval") - m).alias("d"), F.lit(i).alias("i"), F.lit(f"{name}_NATIVO").alias("o")) for i, (name, m) in enumerate([("M1", 1), ("M5", 5), ("M10", 10), ("M15", 15), ("M20", 20), ("M30", 30), ("H1", 60)])])
    near = F.when(F.col("mean_interval").isNull(), "DESCONOCIDO").when(F.col("mean_interval") < 0.75, "TICKS_NATIVO").otherwise(F.array_min(choices)["o"])
    old = F.col("data_origin") if "data_origin" in bars.columns else F.lit(None).cast("string")
    origin = F.when(F.coalesce(old.contains("IMPUTADO"), F.lit(False)), old)
    origin = origin.when(~is_market_open(), "M5_FUERA_DE_HORARIO").otherwise(near) if market_hours else origin.otherwise(near)
    return t.withColumn("data_origin", origin).withColumn("quality_score", score_of())


def validate(bars: DataFrame) -> DataFrame:
    known = F.col("data_origin").isin(*DATA_ORIGINS)
    return bars.agg(F.count("*").alias("n"), F.count_if(F.col("data_origin").isNull()).alias("null_origin"), F.count_if(~known).alias("unknown_origin"), F.count_if(~F.col("quality_score").between(0, 1)).alias("bad_score"))


def score_bucket(score: Column | str = "quality_score") -> Column:
    s = F.col(score) if isinstance(score, str) else score
    return F.when(s >= 0.9, "excellent").when(s >= 0.7, "good").when(s >= 0.5, "fair").otherwise("poor")


def breakdown(bars: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, category, n, avg_score)."""
    return bars.groupBy(*keys, category_of().alias("category")).agg(F.count("*").alias("n"), F.round(F.avg("quality_score"), 6).alias("avg_score"))


def grade(score: Column) -> Column:
    return F.when(score >= 0.9, "A").when(score >= 0.8, "B").when(score >= 0.7, "C").when(score >= 0.6, "D").otherwise("F")
