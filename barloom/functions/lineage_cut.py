"""Reliable checkpoints in the folder that the cluster names."""

from __future__ import annotations

import gc
import tempfile
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a folder of this machine, which only a local master can share."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared is not None:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="barloom-shared-")


#: Spark's own setting: an action that ends frees the shuffle files of its plan. Read when a DataFrame is made.
_FREES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Actions on DataFrames made inside leave no shuffle files; were such a plan run again, they would be made anew."""
    before = spark.conf.get(_FREES, "false")
    spark.conf.set(_FREES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREES, before)


def materialize(df: DataFrame) -> DataFrame:
    """df written to the shared checkpoint folder and read again; the shuffle files that it took are gone then."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    with freeing_shuffles(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Have checkpoints that nothing refers to any more deleted now: Spark does so only after a collection.

    Python tells the JVM of the objects that it let go from a thread that looks once a second.
    """
    gc.collect()
    time.sleep(1.2)
    spark.sparkContext._jvm.System.gc()
