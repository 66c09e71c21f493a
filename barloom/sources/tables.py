"""Readers, adaptors and sinks."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAR_DEFAULTS = {
    "open": ("double", 0.0), "high": ("double", 0.0), "low": ("double", 0.0), "close": ("double", 0.0), "tick_volume": ("int", 0), "real_volume": ("int", 0),
    "spread": ("double", 0.0), "data_flag": ("string", "unknown"), "quality_score": ("double", 0.0), "source_timeframe": ("string", "unknown"),
    "capture_method": ("string", "unknown"), "returns": ("double", 0.0), "log_return": ("double", 0.0),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_bars(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet, CSV (also gzipped), JSON or Feather by extension; other kinds are refused. time becomes a timestamp."""
    kind = path.removesuffix(".gz").rsplit(".", 1)[-1].lower()
    if kind == "parquet":
        df = spark.read.parquet(path)
    elif kind == "csv":
        df = (spark.read.schema(schema) if schema else spark.read.option("inferSchema", True)).option("header", True).csv(path)
    elif kind in ("json", "jsonl"):
        df = (spark.read.schema(schema) if schema else spark.read).json(path)
    elif kind in ("feather", "arrow"):
        df = read_feather(spark, path)
    else:
        raise ValueError(f"unsupported bar file: {path}")
    return df.withColumn("time", F.col("time").cast("timestamp_ntz")) if "time" in df.columns else df


def read_feather(spark: SparkSession, path: str) -> DataFrame:
    """Arrow files on a path that all executors share: the driver reads the schema, executors the record batches."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import from_arrow_schema

    with pa.memory_map(path) as f:
        reader = pa.ipc.open_file(f)
        schema, n = reader.schema, reader.num_record_batches

    def run(batches):
        for batch in batches:
            with pa.memory_map(path) as f:
                reader = pa.ipc.open_file(f)
                for i in batch.column(0).to_pylist():
                    yield reader.get_batch(i)

    return spark.range(0, n, 1, max(1, n)).mapInArrow(run, from_arrow_schema(schema, prefer_timestamp_ntz=True))


def rates_range(bars: DataFrame, start: str, end: str) -> DataFrame:
    return bars.where(F.col("time").between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))


def rates_from(bars: DataFrame, start: str, n: int) -> DataFrame:
    return bars.where(F.col("time") >= F.lit(start).cast("timestamp_ntz")).orderBy("time").limit(n)


def rates_from_pos(bars: DataFrame, pos: int, n: int) -> DataFrame:
    """n bars, pos bars back from the latest."""
    return bars.orderBy(F.desc("time")).offset(pos).limit(n)


def first_non_empty(readers) -> DataFrame | None:
    """The first reader whose table has rows wins."""
    return next((df for df in (r() for r in readers) if not df.isEmpty()), None)


def resolve_alias(candidates: list[str], available: set[str]) -> str | None:
    return next((c for c in candidates if c in available), None)


def with_capture_columns(bars: DataFrame, timeframe: str, method: str, score: float) -> DataFrame:
    return bars.withColumns({"source_timeframe": F.lit(timeframe), "capture_method": F.lit(method), "quality_score": F.lit(score), "data_flag": F.lit(f"real_{timeframe}")})


def conform(df: DataFrame, defaults: dict = BAR_DEFAULTS) -> DataFrame:
    """Missing columns get their default; present ones are cast, what can't be cast becomes null."""
    rest = [c for c in df.columns if c not in defaults]
    own = [(F.col(c).try_cast(kind) if c in df.columns else F.lit(value).cast(kind)).alias(c) for c, (kind, value) in defaults.items()]
    return df.select(*[F.col(f"`{c}`") for c in rest], *own)


def write_bars(df: DataFrame, path: str, formats: tuple[str, ...] = ("parquet", "csv")) -> None:
    """Parquet with zstd, CSV with gzip; executors write parts side by side."""
    if "parquet" in formats:
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}.parquet")
    if "csv" in formats:
        df.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(f"{path}.csv")


def write_splits(df: DataFrame, path: str) -> None:
    """The rows by split and role, and beside them split_info: a row a split with counts and bounds."""
    df.write.mode("overwrite").partitionBy("split_id", "role").parquet(path)
    info = df.groupBy("symbol", "split_id", "role").agg(F.count("*").alias("n"), F.min("time").alias("first_time"), F.max("time").alias("last_time"))
    info.coalesce(1).write.mode("overwrite").json(f"{path}_split_info")


def write_reports(tables: dict[str, DataFrame], path: str, kind: str = "csv") -> list[str]:
    """Small result tables, each below its name as CSV with a header, Parquet or JSON; the paths."""
    out = []
    for name, df in tables.items():
        w = df.coalesce(1).write.mode("overwrite")
        (w.option("header", True) if kind == "csv" else w).format(kind).save(f"{path}/{name}")
        out.append(f"{path}/{name}")
    return out


def check_file(path: str, kinds: tuple[str, ...] = ("parquet", "csv", "feather", "json")) -> list[str]:
    """What is wrong with a file before it is read: nothing if the list is empty."""
    p = Path(path)
    if not p.exists():
        return ["missing"]
    wrong = []
    kind = path.removesuffix(".gz").rsplit(".", 1)[-1].lower()
    if kind not in kinds:
        wrong.append("extension")
    if p.is_file():
        if p.stat().st_size == 0:
            wrong.append("empty")
        elif path.endswith(".csv"):
            with p.open(encoding="utf-8", errors="replace") as f:
                if "," not in f.readline(1 << 16):
                    wrong.append("header")
    return wrong


def verify_written(spark: SparkSession, path: str) -> tuple[int, int]:
    df = read_bars(spark, path)
    return df.count(), len(df.columns)


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of every file; a file is read in pieces, so its size does not matter."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")

    def digest(batches):
        import hashlib
        from urllib.parse import unquote, urlparse

        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            out = []
            for p in batch.column(0).to_pylist():
                u = urlparse(p)
                system, name = (fs.LocalFileSystem(), unquote(u.path)) if u.scheme in ("", "file") else fs.FileSystem.from_uri(p)
                h = hashlib.sha256()
                with system.open_input_stream(name) as f:
                    while piece := f.read(1 << 24):
                        h.update(piece)
                out.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["path", "length", "sha256"])

    return files.mapInArrow(digest, "path string, length long, sha256 string")


def find_dataset(folder: str, name: str, extensions: tuple[str, ...] = ("parquet", "feather", "csv")) -> str | None:
    """Exact name, then a similar one, then any; newest first."""
    files = [p for p in Path(folder).iterdir() if p.suffix.lstrip(".") in extensions]
    files.sort(key=lambda p: -p.stat().st_mtime)
    for fits in (lambda p: p.stem == name, lambda p: name.lower() in p.stem.lower(), lambda p: True):
        if hit := next((p for p in files if fits(p)), None):
            return str(hit)
    return None


class YearCheckpoint:
    """Last completed year in a JSON file; a failed year is not completed."""

    def __init__(self, path: str):
        self.path = Path(path)

    def resume_at(self, first: int) -> int:
        return json.loads(self.path.read_text())["last_completed_year"] + 1 if self.path.exists() else first

    def done(self, year: int) -> None:
        self.path.write_text(json.dumps({"last_completed_year": year}))
