"""Deep pages over an index of sorted ranges (SRT3, QRY1).

``build`` sorts the rows into ranges of the page order, one folder each, and counts them.
A page is answered from the ranges that it overlaps: the sums of the counts before give
the place where each range starts, so an offset of any size reads one range or two.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiflow.operators.registry import LIST_COLUMNS, check_page
from regiflow.schema import PAGE_LIMIT_DEFAULT

RANGE_ROWS = 1 << 18


class PageIndex(NamedTuple):
    rows: DataFrame        # LIST_COLUMNS and _range (partition)
    starts: DataFrame      # _range, first (rows in the ranges before) and n: a row per range


def _order(key: str) -> list:
    return [F.col(c).asc_nulls_last() for c in (key, *[c for c in LIST_COLUMNS if c != key])]


def build(companies: DataFrame, folder: str, key: str = "cnpj_basico", range_rows: int = RANGE_ROWS) -> PageIndex:
    """Write the page index of the companies below ``folder``."""
    spark, df = companies.sparkSession, companies.select(*LIST_COLUMNS)
    ranges = max(1, -(-df.count() // range_rows))
    dealt = df.repartitionByRange(ranges, *_order(key)).withColumn("_range", F.spark_partition_id())
    dealt.sortWithinPartitions("_range", *_order(key)).write.mode("overwrite").partitionBy("_range").parquet(f"{folder}/rows")
    # the sums stand in one small row per range, and are made once
    stored = spark.read.schema(dealt.schema).parquet(f"{folder}/rows")
    counts = sorted((r["_range"], r["n"]) for r in stored.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect())
    first, starts = 0, []
    for r, n in counts:
        starts.append((r, first, n))
        first += n
    spark.createDataFrame(starts, "_range int, first long, n long").coalesce(1).write.mode("overwrite").parquet(f"{folder}/starts")
    return PageIndex(stored, spark.read.parquet(f"{folder}/starts"))


def open_index(spark: SparkSession, folder: str) -> PageIndex:
    """An index written before (of at least one row)."""
    return PageIndex(spark.read.parquet(f"{folder}/rows"), spark.read.parquet(f"{folder}/starts"))


def page(index: PageIndex, limit: int = PAGE_LIMIT_DEFAULT, offset: int = 0, key: str = "cnpj_basico") -> DataFrame:
    """The page that ``registry.list_page`` gives for the offset, from the ranges it overlaps."""
    check_page(limit, offset)
    hit = index.starts.where((F.col("first") < offset + limit) & (F.col("first") + F.col("n") > offset)).collect()   # at most limit + 1 ranges
    rows = index.rows.where(F.col("_range").isin([r["_range"] for r in hit])).drop("_range")
    skip = offset - min((r["first"] for r in hit), default=offset)
    out = rows.orderBy(*_order(key))
    return (out.offset(skip) if skip else out).limit(limit)
