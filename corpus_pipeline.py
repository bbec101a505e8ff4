"""The corpus pipeline: documents that are clean, distinct and packed for training."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from casetrends.llm.common import shared_folder
from casetrends.llm.decontamination import remove_documents
from casetrends.llm.jaccard_join import one_of_each_class
from casetrends.llm.line_dedup import dedup_lines
from casetrends.llm.quality import quality_filter
from casetrends.llm.queries import packed


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_filter(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier document holds."""
    return dedup_lines(docs, counts=None)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal or similar ones."""
    return one_of_each_class(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't repeat benchmark items."""
    return remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of a document stands in the training sequences."""
    return packed(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", jaccard_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

# The near-duplicate stage and the tokenizer are no SQL; tests hold the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; each one's rows are written below the folder of
    ``spark.checkpoint.dir`` and read from there by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
