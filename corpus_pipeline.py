"""A training corpus from ``documents``: filter, deduplicate, decontaminate, mix.

Each stage reads what the one before it wrote, and its decisions take effect: documents that the
quality rules reject are gone, repeated lines are cut out, one document of each near-duplicate
group stays, documents that overlap a benchmark item go, and what is left is given its place in
the mix.  ``run`` writes every stage to the folder the cluster shares.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pruefspur.hadoop import fresh_folder
from pruefspur.llm import decontaminate, linededup, mixing, neardup, quality
from pruefspur.llm.frames import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy; a null or empty text does not."""
    return quality.filtered(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines whose class has an earlier line are cut out, equal lines of every length; a document with
    no line left goes."""
    return linededup.filtered(docs, least_equal=0)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group; documents without an id stay."""
    return neardup.filtered(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no item of ``benchmark``."""
    return decontaminate.filtered(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its block and place in the mix."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
]

#: The edit join, the signatures and the schedule are not SQL; the tests hold every stage against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``, each written as Parquet and read again."""
    folder = fresh_folder(spark, "corpus")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
