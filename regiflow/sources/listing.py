"""File and object inventories (SRC5, SRC7-10, HSH1).

* ``inventory``: every file under a root as ``(key, size_bytes,
  last_modified)`` from Spark's ``binaryFile`` source with the content column
  pruned, so listing reads no file bytes.
* ``with_content_hash``: SHA-256 of each file (``sha2`` on the content,
  files below 2 GB); ``hash_files_streaming`` hashes files of any size as
  streams inside executors.
* ``webdav_listing``: a saved WebDAV multistatus response parsed with the XML
  source into ``(name, is_dir, size, etag)``.
* ``parquet_row_counts``: rows per Parquet file of a folder.

Spark's file scans skip zero-byte files, so an empty object does not appear
in ``inventory`` (it is then reported as missing, which for an archive is the
right outcome: an empty archive holds no data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiflow.functions.text import last_component, strip_quotes
from regiflow.sources.byte_stream import file_hashes

def _key(path_col, root: str):
    root = root.rstrip("/")
    # binaryFile returns fully qualified URIs (file:/..., s3a://...).
    rel = F.regexp_replace(path_col, r"^.*?" + _escape(root.split(":", 1)[-1].lstrip("/")) + "/?", "")
    return rel


def _escape(s: str) -> str:
    import re
    return re.escape(s)


def inventory(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(key, path, size_bytes, last_modified) of every file below ``root``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(root)
    return df.select(_key(F.col("path"), root).alias("key"), "path", F.col("length").alias("size_bytes"),
                     F.col("modificationTime").alias("last_modified"))


def with_content_hash(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Inventory plus ``content_hash`` = SHA-256 hex of each file (files < 2 GB)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(root)
    return df.select(_key(F.col("path"), root).alias("key"), "path", F.col("length").alias("size_bytes"),
                     F.col("modificationTime").alias("last_modified"), F.sha2(F.col("content"), 256).alias("content_hash"))


def hash_files_streaming(files: DataFrame, path_col: str = "path") -> DataFrame:
    """SHA-256 of files of any size, read as streams from any file system.

    The paths, file metadata of one inventory, go to the reader as a list.
    """
    paths = [r[0] for r in files.select(path_col).distinct().collect()]
    spark = files.sparkSession
    if not paths:
        return spark.createDataFrame([], f"{path_col} string, content_hash string")
    return file_hashes(spark, paths).withColumnRenamed("path", path_col)


# What is read of a multistatus reply's entries; a type that holds elements is kept as their text.
_ENTRY = "href string, propstat array<struct<prop: struct<resourcetype: string, getcontentlength: string, getetag: string>>>"


def webdav_listing(spark: SparkSession, path: str, base_href: str | None = None) -> DataFrame:
    """(href, name, is_dir, size, etag) from saved WebDAV multistatus XML; each listing's own folder is dropped.

    Entries are parsed one by one, whatever prefix the server binds to the DAV namespace; a
    property is taken from the first status group that has it.  Without ``base_href`` a
    listing's own folder is the entry that all its other entries lie below.  Listings of
    files only, of folders only and empty ones have the same columns.
    """
    read = spark.read.format("xml").option("rowTag", "response").option("ignoreNamespace", "true").schema(_ENTRY).load(path)
    first = lambda name: F.get(F.filter(F.transform("propstat", lambda p: p["prop"][name]), lambda v: v.isNotNull() & (v != "")), F.lit(0))
    entries = read.select(
        F.col("_metadata.file_path").alias("_file"), F.regexp_replace(F.trim("href"), "/+$", "").alias("href"),
        F.coalesce(F.exists("propstat", lambda p: p["prop"]["resourcetype"].rlike(r"<(?:[\w.-]+:)?collection\b")), F.lit(False)).alias("is_dir"),
        F.trim(first("getcontentlength")).try_cast("long").alias("size"), F.trim(first("getetag")).alias("etag"))
    if base_href is not None:
        entries = entries.where(F.col("href") != base_href.rstrip("/"))
    else:
        # a folder that all others lie below comes first by name; it has a row per listing
        own = entries.groupBy("_file").agg(F.min("href").alias("_own"))
        inside = (F.col("href") == F.col("_own")) | F.col("href").startswith(F.concat("_own", F.lit("/")))
        own = entries.join(own, "_file").groupBy("_file", "_own").agg(
            F.bool_and(inside).alias("_all"), F.bool_or((F.col("href") == F.col("_own")) & F.col("is_dir")).alias("_dir"))
        entries = entries.join(own.where("_all and _dir").select("_file", F.col("_own").alias("href")), ["_file", "href"], "left_anti")
    return entries.select("href", last_component(F.col("href")).alias("name"), "is_dir", "size",
                          F.when(F.col("etag") != "", strip_quotes(F.col("etag"))).alias("etag"))


def month_folders(listing: DataFrame) -> DataFrame:
    """Sorted distinct ``YYYY-MM`` directories of a listing (FLT6, SET4)."""
    return (listing.where(F.col("is_dir") & F.col("name").rlike(r"^\d{4}-\d{2}$"))
            .select(F.col("name").alias("year_month")).distinct().orderBy("year_month"))


def archive_files(listing: DataFrame) -> DataFrame:
    """Files ending in ``.zip`` or ``.tar.gz`` (case-insensitive, FLT7)."""
    n = F.lower(F.col("name"))
    return listing.where(~F.col("is_dir") & (n.endswith(".zip") | n.endswith(".tar.gz")))


def parquet_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per Parquet file of ``folder`` and its month folders: (year_month, parquet_file, size_bytes, row_count).

    The month is the file's folder, ``2025-06`` or ``year_month=2025-06``; null outside one.
    """
    df = spark.read.option("recursiveFileLookup", "true").parquet(folder)
    month = F.regexp_extract("_metadata.file_path", r"/(?:year_month=)?([0-9]{4}-[0-9]{2}|BASE)/", 1)
    return (df.select(F.when(month != "", month).alias("year_month"), F.col("_metadata.file_name").alias("parquet_file"),
                      F.col("_metadata.file_size").alias("size_bytes"))
            .groupBy("year_month", "parquet_file", "size_bytes").agg(F.count(F.lit(1)).alias("row_count")))
