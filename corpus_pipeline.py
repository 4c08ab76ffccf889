"""The corpus pipeline: quality, near duplicates, personal data, mixing, packing; each stage works on what the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratavox.llm.common import configure, materialise, table
from stratavox.llm.jaccard import keep_first
from stratavox.llm.mixing import mixed
from stratavox.llm.packing import pack
from stratavox.llm.personal import redact
from stratavox.llm.quality import keep_good

#: SQL cannot express the classifier or the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a field over lines, taught by the labels of these documents, finds good."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group linked by shingles of five words and a Jaccard similarity of 0.8."""
    return keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind in brackets."""
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as systematic sampling to the sources' weights draws it."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in windows of 4096 token ids."""
    return pack(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mixing", mixing), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written as Parquet and read again by the next."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
