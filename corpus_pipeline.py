"""Corpus pipeline: documents become a clean, encoded training corpus.

Every stage takes (spark, docs, folder of the tables), calls one operator of
the ``llm`` subpackage on all documents that the stage before it kept, and
returns a table that is written as Parquet before the next one reads it. All
but the last return the columns of ``documents``. Null texts, empty tables and
further columns pass through as the operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortloom.llm import decontaminate, line_dedup, sentence_pieces, simhash, toxicity
from cohortloom.llm.common import table
from cohortloom.session import settle


def toxicity_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that score as toxic go. The model learns from ``labels``, its characters from these documents."""
    return toxicity.drop_toxic(docs, table(spark, folder, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """A line whose template an earlier document has is dropped; no document goes."""
    return line_dedup.drop_recurring(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near copies (fingerprints of three-word shingles, at most three differing bits) the document with the smallest id stays."""
    return simhash.keep_one_per_group(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` go."""
    return decontaminate.without_contaminated(docs, table(spark, folder, "benchmark"))


def sentence_pieces_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents with the ids of their best segmentation, and the next best as edits of it."""
    return sentence_pieces.with_pieces(docs, sentence_pieces.load(), docs.columns)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("simhash", simhash_stage),
    ("decontaminate", decontaminate_stage),
    ("sentence_pieces", sentence_pieces_stage),
]

#: SQL cannot express the fitted and the iterative stages; tests compare run() with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, folder), f"pipeline-{name}")
    return docs
