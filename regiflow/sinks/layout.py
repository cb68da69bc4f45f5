"""A warehouse layout for key lookups (FLT1, QRY3).

Rows are bucketed by key and sorted by it inside a bucket, with Bloom filters in the Parquet
footers: a lookup reads the files of one bucket (Spark prunes the others by the key's hash)
and in them the row groups that may hold the key.  A batch lookup joins bucket by bucket
if its keys are bucketed alike.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

BUCKET_ROWS = 1 << 20
MAX_BUCKETS = 100_000        # Spark's own limit (spark.sql.sources.bucketing.maxBuckets)


def bucket_count(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    return min(MAX_BUCKETS, max(1, -(-rows // bucket_rows)))


def write_keyed(df: DataFrame, folder: str, key: str = "cnpj_basico", bucket_rows: int = BUCKET_ROWS, name: str | None = None) -> DataFrame:
    """Write ``df`` as an external bucketed table at ``folder``; returns it."""
    spark = df.sparkSession
    name, n = name or f"keyed_{uuid.uuid4().hex}", bucket_count(df.count(), bucket_rows)
    # one file per bucket: the shuffle has the buckets' hash and number
    (df.repartition(n, key).write.mode("overwrite").bucketBy(n, key).sortBy(key).option("path", folder)
     .option(f"parquet.bloom.filter.enabled#{key}", "true").saveAsTable(name))
    return spark.table(name)
