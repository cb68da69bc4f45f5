"""Source resolution with fallback (SRC12): local copy first, else the store layer.

Both inventories are DataFrames ``(year_month, file_name, location, size_bytes)``; the
choice per file is one grouped ``min_by`` on the priority, so every file gets
exactly one source and no file list passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve_sources(local: DataFrame, store: DataFrame, keys: tuple[str, ...] = ("year_month", "file_name")) -> DataFrame:
    """Per file: the local copy when present, otherwise the store object."""
    both = (local.select(*keys, "location", "size_bytes", F.lit(0).alias("priority"), F.lit("local").alias("origin"))
            .unionByName(store.select(*keys, "location", "size_bytes", F.lit(1).alias("priority"),
                                      F.lit("store").alias("origin"))))
    best = F.min_by(F.struct("location", "size_bytes", "origin"), F.col("priority"))
    return both.groupBy(*keys).agg(best.alias("s")).select(*keys, "s.location", "s.size_bytes", "s.origin")
