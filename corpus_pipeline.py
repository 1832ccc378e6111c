"""A corpus prepared for training: filtered, deduplicated, decontaminated and mixed.

Each stage takes what the one before kept. All but the last return the columns
of ``documents``; the last repeats documents and adds ``copy``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievewright.llm import decontamination, line_dedup, mixing, repetition, simhash
from sievewright.llm.common import materialize, ship


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repetition.keep(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.replace_texts(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage's result is written to the shared folder and read by the next."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


# SQL can express neither the singular value decomposition nor connected components of any depth at this size
ORACLE_SQL = None
