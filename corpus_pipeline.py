"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept.
Between stages the documents are written as Parquet below the shared checkpoint
folder and read again, so a stage never repeats the work of another.  All stages
but the last return the columns of ``documents``; ``n_chars`` follows the text.

Defined cases are those of the operators; documents without an id stay in the
near-duplicate stage, and documents of which the passage stage leaves no word go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiflow.llm import ngram_join, packing, pii, quality, suffix_dedup
from regiflow.llm.graph import saved_table
from regiflow.llm.queries import read, tokenizer_path

PASSAGE_BYTES = 250     # passages of over 50 words have 270 bytes and more; operator 8's own 400 would miss most of them


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that fail a base rule or a risk-controlled cutoff go."""
    return quality.judge(docs, read(spark, sf_dir, "labels")).where("kept").select(docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: of documents with similar sets of five words (0.8 or more) the smallest id stays."""
    return ngram_join.one_of_each(docs, ngram_join.near_groups(docs, words=5, percent=80))


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: byte strings of ``PASSAGE_BYTES`` that occur more than once go from the texts."""
    return _counted(suffix_dedup.rest_as_text(suffix_dedup.dedup_bytes(docs, length=PASSAGE_BYTES), docs))


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: personal data and the terms that reveal it are replaced."""
    return _counted(pii.sanitise(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: where each piece of each document stands in the training sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("quality", keep_quality), ("near_duplicates", keep_one_of_each), ("repeated_passages", remove_repeats),
          ("personal_data", remove_personal_data), ("packing", pack)]
ORACLE_SQL = None      # suffix arrays, connected components and tokenisation have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved_table(docs)
    return docs
