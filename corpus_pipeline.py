"""A corpus pipeline: toxicity, quality rules, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. ``run`` writes each stage's rows as
Parquet to the shared folder and rereads them as the next stage's input.

Defined results: a row that a stage rejects is gone for the stages after it; an
empty table passes through; null texts are not toxic, fail the quality rules
and so never reach the later stages; input columns beyond those of ``documents``
are kept up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segstream.llm.common import fresh_folder, table
from segstream.llm.neardup import one_of_each
from segstream.llm.packing import pack_documents
from segstream.llm.quality import filter_documents
from segstream.llm.toxicity import score_column

TOXIC_FROM = 0.3


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays under ``TOXIC_FROM``."""
    return docs.where(score_column(docs, table(spark, sf_dir, "labels")) < F.lit(TOXIC_FROM))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that keep enough text, without the lines that repeat too often."""
    return filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five words, similarity 0.8)."""
    return one_of_each(docs, k=5, percent=80)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of the documents lies in the training sequences."""
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("quality rules", quality), ("near-duplicates", near_duplicates), ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        folder = fresh_folder(spark, f"stage{i}")
        out.write.parquet(folder)
        docs = spark.read.schema(out.schema).parquet(folder)
    return docs
