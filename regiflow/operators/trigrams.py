"""Substring search over a trigram posting index (FLT2, QRY2).

``build`` writes two tables below a folder: the rows, sorted by key and numbered in blocks
of ``BLOCK_ROWS``, and for every three consecutive characters of the lower-cased names the
sorted list of the blocks they occur in.  A search cuts its term at the wildcards, reads
the postings of the pieces' trigrams only (they are bucketed by hash, so other buckets are
not opened), keeps the blocks that all of them have, and verifies the rows of these blocks
with ``ilike``.  The index decides what is read, never what is found.

A term without three consecutive plain characters has no trigram; every block is then read.

Nothing grows hot: a trigram is sent once per block, and its list has one number per block.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiflow.operators.registry import LIST_COLUMNS, search_pattern

BLOCK_ROWS = 4096        # rows that one entry of a posting stands for, about
CHUNK_BLOCKS = 64        # blocks of a folder of the rows' table
BUCKETS = 64             # folders of the postings' table


class TrigramIndex(NamedTuple):
    rows: DataFrame         # the indexed columns, _block and _chunk (partition)
    postings: DataFrame     # gram, blocks and bucket (partition)


def _grams(text: Column) -> Column:
    """The distinct trigrams of a lower-cased text."""
    size = F.length(text)
    starts = F.when(size >= 3, F.sequence(F.lit(1), size - 2)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(3))))


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def build(rows: DataFrame, folder: str, column: str = "razao_social", key: str = "cnpj_basico", block_rows: int = BLOCK_ROWS) -> TrigramIndex:
    """Write the index of ``rows`` below ``folder``.

    Blocks are ranges of (key, hash of the row): each sorted part of the rows is cut into blocks of equal size.
    """
    spark = rows.sparkSession
    n = rows.count()
    parts = max(1, -(-n // (block_rows * CHUNK_BLOCKS)))
    order = [F.col(key).asc_nulls_last(), F.xxhash64(*rows.columns)]
    sorted_ = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()                      # partition number << 33 and the place in it
    numbered = sorted_.withColumn("_place", place).select(
        *rows.columns, (F.shiftright("_place", 33) * (1 << 20) + F.expr(f"(_place & {(1 << 33) - 1}) div {block_rows}")).alias("_block"),
        F.shiftright("_place", 33).alias("_chunk"))
    numbered.write.mode("overwrite").partitionBy("_chunk").parquet(f"{folder}/rows")
    stored = spark.read.schema(numbered.schema).parquet(f"{folder}/rows")
    grams = stored.select("_block", F.explode(_grams(F.lower(column))).alias("gram")).distinct()
    postings = grams.groupBy("gram").agg(F.sort_array(F.collect_list("_block")).alias("blocks"))
    postings = postings.withColumn("bucket", _bucket(F.col("gram")))
    postings.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/postings")
    return TrigramIndex(stored, spark.read.schema(postings.schema).parquet(f"{folder}/postings"))


def open_index(spark: SparkSession, folder: str) -> TrigramIndex:
    """An index written before (of at least one row)."""
    return TrigramIndex(spark.read.parquet(f"{folder}/rows"), spark.read.parquet(f"{folder}/postings"))


def term_grams(spark: SparkSession, term: str, escape: bool = False) -> list[str]:
    """Trigrams that every match of the term has, lower-cased as the index is."""
    pieces = [term] if escape else re.split(r"\\.|[%_]", term)       # a wildcard or an escaped character ends a piece
    pieces = [p for p in pieces if len(p) >= 3]
    if not pieces:
        return []
    return sorted({g for r in spark.createDataFrame([(p,) for p in pieces], "p string").select(_grams(F.lower("p")).alias("g")).collect() for g in r.g})


def candidate_blocks(index: TrigramIndex, grams: list[str]) -> DataFrame:
    """(_block) of the blocks that have all trigrams, from their postings alone."""
    spark = index.postings.sparkSession
    buckets = [r[0] for r in spark.createDataFrame([(g,) for g in grams], "g string").select(_bucket(F.col("g"))).distinct().collect()]
    mine = index.postings.where(F.col("bucket").isin(buckets) & F.col("gram").isin(grams))
    return mine.select(F.explode("blocks").alias("_block")).groupBy("_block").count().where(F.col("count") == len(grams)).select("_block")


def search(index: TrigramIndex, term: str, escape: bool = False, column: str = "razao_social") -> DataFrame:
    """Every row whose name has the term, as ``registry.search_all`` finds them."""
    pattern = search_pattern(term, escape)
    rows = index.rows
    grams = term_grams(rows.sparkSession, term, escape)
    if grams:
        blocks = candidate_blocks(index, grams).withColumn("_chunk", F.shiftright("_block", 20))
        rows = rows.join(blocks, ["_chunk", "_block"], "left_semi")
    return rows.where(F.col(column).ilike(pattern)).select(*LIST_COLUMNS)
