"""Headerless ``;``-separated ISO-8859-1 registry text (SRC1, SRC3, SRC11, SET5).

One ``spark.read.csv`` over every part file of an entity: the files split
into tasks by ``spark.sql.files.maxPartitionBytes`` (no driver-side chunking),
all columns stay strings, and records with a wrong field count are kept in a
quarantine column instead of being shifted or dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiflow.functions.text import file_type, last_component
from regiflow.schema import LAYOUTS, raw_schema

CORRUPT = "_corrupt_record"


def csv_options(multi_line: bool = False) -> dict[str, str]:
    return {
        "sep": ";", "encoding": "ISO-8859-1", "header": "false", "quote": '"', "escape": '"',
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "multiLine": str(multi_line).lower(),
        # Keep text as written: no trimming, empty fields become null (an NA token).
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    }


def read_entity(spark: SparkSession, paths: str | list[str], entity: str, multi_line: bool = False,
                with_source: bool = True) -> DataFrame:
    """All part files of one entity as raw text with ``_corrupt_record``.

    ``multi_line=True`` handles quoted newlines but makes each file one task
    (unsplittable); the default splits files and quarantines such records.
    """
    if entity not in LAYOUTS:
        raise ValueError(f"unknown entity {entity!r}")
    schema = raw_schema(entity).add(T.StructField(CORRUPT, T.StringType(), True))
    reader = spark.read.schema(schema)
    for k, v in csv_options(multi_line).items():
        reader = reader.option(k, v)
    df = reader.csv(paths)
    if with_source:
        # a part that Spark wrote into a ``source_file=`` folder is named by the folder
        folder = F.regexp_extract("_metadata.file_path", r"/source_file=([^/]+)/[^/]*$", 1)
        df = df.withColumn("source_file", F.when(folder != "", folder).otherwise(F.col("_metadata.file_name")))
    return df


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows without the corrupt column, quarantined records).

    Quarantined rows keep the partially parsed fields next to the raw text
    (Spark also refuses queries that read only the corrupt-record column).
    """
    data = [c for c in df.columns if c not in (CORRUPT, "source_file")]
    # Always true, but it reads every data column: the CSV parser only checks
    # field counts over the columns a query needs, so without it a count of
    # either side (or a query of the corrupt column alone) classifies rows
    # differently from a full read.
    touch = F.length(F.concat_ws("", *[F.col(c) for c in data])) >= 0
    good = df.where(F.col(CORRUPT).isNull() & touch).drop(CORRUPT)
    bad = df.where(F.col(CORRUPT).isNotNull() & touch)
    return good, bad


def read_by_type(spark: SparkSession, root: str, entity: str, multi_line: bool = False) -> DataFrame:
    """Every file under ``root`` whose name routes to ``entity`` (multi-part union).

    Names are routed with the same rule as archives (case-insensitive prefix,
    e.g. ``estabelecimentos3.csv``); only the matching part files are opened,
    in one scan.  The list passed to the reader is file metadata of one folder.
    """
    from regiflow.sources.listing import inventory
    files = (inventory(spark, root).select("path", last_component(F.col("key")).alias("name"))
             .where(file_type(F.col("name")) == entity))
    paths = [r["path"] for r in files.collect()]
    if not paths:
        raise FileNotFoundError(f"no {entity} files under {root}")
    return read_entity(spark, paths, entity, multi_line)


def sample_per_file(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` records of each file (profiling sample, SRC11).

    Order inside a file is the byte offset of the record's split plus its
    position in the split; the ranked window keeps at most ``n`` rows per file
    before any shuffle (window group limit).
    """
    pos = F.monotonically_increasing_id()
    w = Window.partitionBy("source_file").orderBy("__pos")
    return (df.withColumn("__pos", pos).withColumn("__rk", F.row_number().over(w))
            .where(F.col("__rk") <= n).drop("__pos", "__rk"))


def source_entity(df: DataFrame) -> DataFrame:
    """Add the entity type routed from the source file name."""
    return df.withColumn("file_type", file_type(last_component(F.col("source_file"))))
