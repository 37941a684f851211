"""Build a training corpus: judge quality, drop copies, near copies and leaks, mix sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadlens.llm.common import table, write_table
from loadlens.llm.decontaminate import drop_contaminated
from loadlens.llm.exact_dedup import drop_copies
from loadlens.llm.mixing import mix_sources
from loadlens.llm.quality import drop_rejected
from loadlens.llm.simhash import drop_near_copies


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return drop_rejected(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_copies(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_copies(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their source's target weight, in global random order."""
    return mix_sources(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
]

#: The classifier is fitted and near copies are components, which SQL cannot state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
