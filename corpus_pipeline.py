"""The corpus pipeline: documents through quality rules, near-dedup, substring dedup, decontamination and packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. A stage's result is written as
Parquet under the shared folder and read again as the next one's input; it is removed once that one is written.

All stages: an empty table gives an empty table, null and repeated ids are allowed, columns may have any names and all but
the last stage return them as they came. A stage holds single texts in memory, never groups of them.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from barloom.functions.lineage_cut import shared_folder
from barloom.llm import decontam, packing, quality, simhash, spans
from barloom.llm.common import table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the default policy; null and empty texts fail it, repeated rows are judged each by itself."""
    return quality.keep_documents(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 on five-word shingles, the one of the least id; of equal rows, one."""
    return simhash.drop_near_duplicates(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sentences in a repeated span go but for the first by id; a document of which nothing else is left goes. Null texts stay."""
    return spans.keep_unrepeated(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found; null and empty texts stay, repeated rows are judged alike."""
    return decontam.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row a piece; a null or empty text is the separator alone, repeated rows are packed as often as they occur."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("substring_dedup", substring_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: SQL can't express similarity groups, sentence spans and packing: tests/llm/test_pipeline.py runs all stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/corpus_pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for i, (name, stage) in enumerate(STAGES):
        here = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(here)
        docs = spark.read.parquet(here)
        if before:
            remove(spark, before)
        before = here
    return docs


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
