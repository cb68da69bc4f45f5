"""Row counts of Parquet tables from their footers (SRC5).

Spark pushes a count by partition columns into its Parquet reader, which then answers it
from the footers' row groups, in tasks over the files; no page is read.  This needs the
reader of the second source interface, which a session of its own is set to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def footer_counts(spark: SparkSession, folder: str, by: tuple[str, ...] = ("year_month", "source_file")) -> DataFrame:
    """(*by, row_count) of a table that is partitioned by the columns ``by``: one row per partition."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    table = own.read.parquet(folder)
    missing = [c for c in by if c not in table.columns]
    if missing:
        raise ValueError(f"{folder} is not partitioned by {', '.join(missing)}")
    return table.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"))


def footer_statistics(spark: SparkSession, folder: str, by: tuple[str, ...] = ("year_month", "source_file")) -> DataFrame:
    """(*by, files, size_bytes, row_count): rows from the footers, sizes from the listing."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folder)
    part = [F.url_decode(F.url_decode(F.regexp_extract("path", rf"/{c}=([^/]+)/", 1))).alias(c) for c in by]
    sizes = listed.select(*part, F.col("length").alias("n")).groupBy(*by).agg(
        F.count(F.lit(1)).alias("files"), F.sum("n").cast("long").alias("size_bytes"))
    counts = footer_counts(spark, folder, by).select(*[F.col(c).cast("string").alias(c) for c in by], "row_count")
    return sizes.join(counts, list(by)).select(*by, "files", "size_bytes", "row_count")
