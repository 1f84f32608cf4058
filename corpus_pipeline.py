"""A training corpus from ``documents``: rules, repeated lines, near copies, benchmark leaks, mixture.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's docs.
All but the last return the columns of ``documents``; the last one has a row per repetition, numbered in ``repetition``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pedalpath.llm.common import drop_written, stored
from pedalpath.llm.decontaminate import without_leaks
from pedalpath.llm.line_dedup import WHOLE, drop_repeated_lines
from pedalpath.llm.mixing import mix_documents
from pedalpath.llm.ngram_join import one_per_component
from pedalpath.llm.quality import clean_documents


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failed lines go, then documents that lost too much or fail as a whole."""
    return clean_documents(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines go, single lines of three words too, and documents with nothing left."""
    return drop_repeated_lines(docs, WHOLE)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest number."""
    return one_per_component(docs)


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` go."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks."""
    return mix_documents(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_copy_stage),
    ("benchmark decontamination", leak_stage),
    ("source mixing", mixing_stage),
]

#: Line rules, components and sampling over cleaned texts are beyond SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs, path = stored(stage(spark, docs, sf_dir), "pipeline-" + name.lower().replace(" ", "-"))
        if before:
            drop_written(spark, before)
        before = path
    return docs
