"""Integrity and reconciliation: control rows against store/processed inventories.

Each report is one key join (control ⟕ inventory on the object key) plus an
ordered ``CASE`` classification, so every file gets exactly one class and the
class counts add up to the total.  Inventories are never collected; a hot
month or key is split by AQE skew handling of the sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiflow.functions.numbers import to_gb, to_mb
from regiflow.functions.text import file_type, is_mapped, object_key, parquet_name, table_name
from regiflow.schema import DOWNLOADED_OR_LATER, TRANSFORMED_OR_LATER

# A file is known by its month and name: the same names are shipped every month.
FILE_KEY = ["year_month", "parquet_name"]


def _truthy_num(c: Column) -> Column:
    return c.isNotNull() & (c != 0)


def _truthy_str(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def _store(store: DataFrame, prefix: str = "s_") -> DataFrame:
    cols = [c for c in ("key", "size_bytes", "etag", "content_hash") if c in store.columns]
    return store.select(*[F.col(c).alias(prefix + c) for c in cols])


def in_month(df: DataFrame, year_month: str | None) -> DataFrame:
    """Rows of one month, or all: a filter on the partition column, so other months are not read."""
    return df if year_month is None else df.where(F.col("year_month") == year_month)


def per_month(df: DataFrame, year_month: str | None, *aggs: Column) -> DataFrame:
    """One row per month; for a given month exactly one, with zeros if it has no files."""
    if year_month is None:
        return df.groupBy("year_month").agg(*aggs)
    return in_month(df, year_month).agg(F.lit(year_month).alias("year_month"), *aggs)


def month_objects(store: DataFrame, layer: str, year_month: str | None) -> DataFrame:
    """Objects of one layer and month, or the whole store."""
    return store if year_month is None else store.where(F.col("key").startswith(f"{layer}/{year_month}/"))


# --- verify (INT1) ------------------------------------------------------------

def verify_integrity(current: DataFrame, store: DataFrame, full_check: bool = False, year_month: str | None = None) -> DataFrame:
    """Issues of downloaded files: missing -> size mismatch -> hash mismatch / read error.

    Only the first issue of a file is reported.  With ``full_check`` the store
    inventory must carry ``content_hash`` (e.g. from ``sources.listing.with_content_hash``).
    """
    recs = in_month(current, year_month).where(F.col("status").isin(DOWNLOADED_OR_LATER)).withColumn(
        "key", object_key("raw", F.col("year_month"), F.col("file_name")))
    j = recs.join(_store(month_objects(store, "raw", year_month)), F.col("key") == F.col("s_key"), "left")
    issue = (F.when(F.col("s_key").isNull(), "missing_in_s3")
             .when(_truthy_num(F.col("local_size_bytes")) & (F.col("s_size_bytes") != F.col("local_size_bytes")),
                   "size_mismatch"))
    if full_check:
        has_hash = _truthy_str(F.col("local_hash"))
        issue = (issue.when(has_hash & F.col("s_content_hash").isNull(), "s3_read_error")
                 .when(has_hash & (F.col("s_content_hash") != F.col("local_hash")), "hash_mismatch"))
    return (j.select("year_month", "file_name", issue.alias("issue"),
                     F.col("local_size_bytes").alias("recorded_size_bytes"),
                     F.col("s_size_bytes").alias("store_size_bytes"))
            .where(F.col("issue").isNotNull()))


# --- remote vs local (INT2) ---------------------------------------------------

DIFF_CLASSES = ["never_downloaded", "missing_hash", "file_missing", "size_mismatch", "changed_remote", "synced"]


def remote_local_diff(current: DataFrame, store: DataFrame, remote: DataFrame | None = None, year_month: str | None = None) -> DataFrame:
    """Classify every control file in one of six classes (first match wins)."""
    recs = in_month(current, year_month).withColumn("key", object_key("raw", F.col("year_month"), F.col("file_name")))
    j = recs.join(_store(month_objects(store, "raw", year_month)), F.col("key") == F.col("s_key"), "left")
    changed = F.lit(False)
    if remote is not None:
        r = remote.select(F.col("year_month").alias("r_ym"), F.col("file_name").alias("r_file"),
                          F.col("etag").alias("listed_etag"))
        j = j.join(r, (F.col("year_month") == F.col("r_ym")) & (F.col("file_name") == F.col("r_file")), "left")
        changed = F.col("listed_etag").isNotNull() & (F.col("listed_etag") != F.col("etag"))
    cls = (F.when(F.col("status") == "pending", "never_downloaded")
           .when(~_truthy_str(F.col("local_hash")), "missing_hash")
           .when(F.col("s_key").isNull(), "file_missing")
           .when(_truthy_num(F.col("file_size_bytes")) & (F.col("s_size_bytes") != F.col("file_size_bytes")),
                 "size_mismatch")
           .when(changed, "changed_remote")
           .otherwise("synced"))
    return j.select("year_month", "file_name", "status", F.col("etag").alias("remote_etag"),
                    F.col("local_hash").alias("local_hash_sha256"), F.col("file_size_bytes").alias("remote_size_bytes"),
                    "local_size_bytes", F.col("s_size_bytes").alias("actual_s3_size"), cls.alias("diff_class"))


def diff_summary(diff: DataFrame, year_month: str | None = None) -> DataFrame:
    """Per month: count of each diff class and the total (classes add up)."""
    return per_month(
        diff, year_month, F.count(F.lit(1)).alias("total_files"),
        *[F.count_if(F.col("diff_class") == c).alias(c) for c in DIFF_CLASSES])


# --- layer check (INT3) -------------------------------------------------------

def layer_check(current: DataFrame, store: DataFrame, layer: str = "raw", year_month: str | None = None) -> DataFrame:
    """Raw layer compares sizes; processed layer checks existence only."""
    current, store = in_month(current, year_month), month_objects(store, layer, year_month)
    if layer == "raw":
        recs = current.where(F.col("status").isin(DOWNLOADED_OR_LATER)).select(
            "year_month", "file_name", F.col("local_size_bytes").alias("expected_size"))
    elif layer == "processed":
        recs = current.where(F.col("status").isin(TRANSFORMED_OR_LATER)).select(
            "year_month", parquet_name(F.col("file_name")).alias("file_name"),
            F.lit(None).cast("bigint").alias("expected_size"))
    else:
        raise ValueError("layer must be 'raw' or 'processed'")
    recs = recs.withColumn("s3_key", object_key(layer, F.col("year_month"), F.col("file_name")))
    j = recs.join(_store(store), F.col("s3_key") == F.col("s_key"), "left")
    exists = F.col("s_key").isNotNull()
    match = F.when(~exists, F.lit(None).cast("boolean")).when(
        F.col("expected_size").isNull(), F.lit(True)).otherwise(F.col("expected_size") == F.col("s_size_bytes"))
    status = F.when(~exists, "missing_in_s3").when(match, "ok").otherwise("size_mismatch")
    return j.select("year_month", "file_name", "expected_size", "s3_key", exists.alias("s3_exists"),
                    F.col("s_size_bytes").alias("s3_size"), match.alias("size_match"), status.alias("status"))


def layer_summary(check: DataFrame, year_month: str | None = None) -> DataFrame:
    return per_month(
        check, year_month, F.count_if(F.col("status") == "ok").alias("ok"),
        F.count_if(F.col("status") == "missing_in_s3").alias("missing_in_s3"),
        F.count_if(F.col("status") == "size_mismatch").alias("size_mismatch"),
        F.count(F.lit(1)).alias("total"))


# --- publish plan (SNK11) -----------------------------------------------------

def upload_plan(local_files: DataFrame, store: DataFrame, skip_existing: bool = True) -> DataFrame:
    """Per local file: ``skip`` when the store already has the key with the same size."""
    j = local_files.join(_store(store), F.col("key") == F.col("s_key"), "left")
    same = F.col("s_key").isNotNull() & (F.col("s_size_bytes") == F.col("local_size_bytes"))
    action = F.when(F.lit(skip_existing) & same, "skip").otherwise("upload")
    return j.select("key", "local_size_bytes", F.col("s_size_bytes").alias("store_size_bytes"),
                    action.alias("action"))


def local_raw_files(current: DataFrame) -> DataFrame:
    """Downloaded archives present locally (key + size), input of the raw upload plan."""
    return current.where(F.col("status").isin(DOWNLOADED_OR_LATER) & F.col("local_size_bytes").isNotNull()).select(
        object_key("raw", F.col("year_month"), F.col("file_name")).alias("key"), "local_size_bytes")


def upload_summary(plan: DataFrame) -> DataFrame:
    return plan.agg(F.count_if(F.col("action") == "upload").alias("uploaded"),
                    F.count_if(F.col("action") == "skip").alias("skipped"),
                    F.coalesce(F.sum(F.when(F.col("action") == "upload", F.col("local_size_bytes"))), F.lit(0))
                    .cast("bigint").alias("upload_bytes"))


# --- transform / load status (INT5, INT6) -------------------------------------

def transform_status(current: DataFrame, stats: DataFrame, year_month: str | None = None) -> DataFrame:
    """Downloaded archives × processed Parquet statistics."""
    current, stats = in_month(current, year_month), in_month(stats, year_month)
    recs = current.where(F.col("status").isin(DOWNLOADED_OR_LATER))
    recs = recs.withColumn("parquet_name", parquet_name(F.col("file_name")))
    st = stats.select("year_month", F.col("parquet_file").alias("parquet_name"), "parquet_file", "size_bytes", "row_count")
    j = recs.join(st, FILE_KEY, "left")
    mapped = is_mapped(F.col("file_name"))
    return j.select(
        "year_month", "file_name", file_type(F.col("file_name")).alias("file_type"), mapped.alias("mapped"),
        F.when(_truthy_num(F.col("local_size_bytes")), to_mb(F.col("local_size_bytes"))).alias("zip_size_mb"),
        F.col("parquet_file").isNotNull().alias("parquet_exists_local"),
        to_mb(F.col("size_bytes")).alias("parquet_size_mb_local"),
        F.col("size_bytes").alias("parquet_size_bytes"), "row_count",
        F.when(~mapped, "not_mapped").otherwise(F.col("status")).alias("status"))


def transform_summary(status: DataFrame, year_month: str | None = None) -> DataFrame:
    return per_month(
        status, year_month, F.count(F.lit(1)).alias("total_zips"),
        F.count_if(F.col("status").isin(TRANSFORMED_OR_LATER)).alias("transformed"),
        F.count_if(F.col("status") == "downloaded").alias("pending"),
        F.count_if(F.col("status") == "not_mapped").alias("not_mapped"),
        F.coalesce(F.sum("row_count"), F.lit(0)).cast("bigint").alias("total_rows_local"),
        to_gb(F.coalesce(F.sum("parquet_size_bytes"), F.lit(0))).alias("total_parquet_gb_local"))


def table_counts(current: DataFrame, stats: DataFrame) -> DataFrame:
    """Rows per warehouse table from the files recorded as loaded."""
    loaded = current.where(F.col("status") == "loaded").select("year_month", parquet_name(F.col("file_name")).alias("parquet_file"))
    # The inner join already makes parquet_file non-null; saying so with a
    # coalesce makes the key non-nullable, so the ``isnotnull(table_name)``
    # that a later join on it would infer is folded away instead of being
    # pushed through both aggregates into the scan of the statistics' source.
    key = F.coalesce(table_name(F.col("parquet_file")), F.lit(""))
    return (stats.join(loaded, ["year_month", "parquet_file"])
            .groupBy(key.alias("table_name"))
            .agg(F.sum("row_count").cast("bigint").alias("db_rows")))


def load_status(current: DataFrame, stats: DataFrame, counts: DataFrame, year_month: str | None = None) -> DataFrame:
    """Processed files × Parquet rows × table rows (of all months); loaded when the table has rows."""
    current, stats = in_month(current, year_month), in_month(stats, year_month)
    recs = current.where(F.col("status").isin(TRANSFORMED_OR_LATER)).select(
        "year_month", parquet_name(F.col("file_name")).alias("file_name"))
    recs = recs.withColumn("table_name", table_name(F.col("file_name")))
    st = stats.select("year_month", F.col("parquet_file").alias("file_name"), "row_count")
    # one join to the counts: they are few, so adaptive execution broadcasts them, and splits a hot table if not
    j = recs.join(st, ["year_month", "file_name"], "left").join(counts, "table_name", "left")
    return j.select("year_month", "file_name", "table_name", F.col("row_count").alias("parquet_rows"), "db_rows",
                    F.when(F.col("db_rows") > 0, "loaded").otherwise("pending").alias("status"))


def load_summary(status: DataFrame, year_month: str | None = None) -> DataFrame:
    """Per month; table rows counted once per table (not once per part file)."""
    per_table = status.groupBy("year_month", "table_name").agg(
        F.count(F.lit(1)).alias("parts"), F.coalesce(F.sum("parquet_rows"), F.lit(0)).alias("parquet_rows"),
        F.coalesce(F.max("db_rows"), F.lit(0)).alias("db_rows"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    s = per_month(
        per_table, year_month, total("parts").alias("total_parquets"), total("parquet_rows").alias("total_parquet_rows"),
        total("db_rows").alias("total_db_rows"),
        F.count_if(F.col("db_rows") > 0).alias("tables_with_data"),
        F.count(F.lit(1)).alias("tables_total"))
    return s.withColumn("coverage_pct", F.coalesce(F.round(
        F.try_divide(F.col("total_db_rows") * F.lit(100.0), F.when(F.col("total_parquet_rows") > 0,
                                                                   F.col("total_parquet_rows"))), 1), F.lit(0.0)))


def coverage(status: DataFrame) -> DataFrame:
    """Per table over all months: Parquet rows, table rows, coverage percent."""
    t = status.groupBy("table_name").agg(
        F.coalesce(F.sum("parquet_rows"), F.lit(0)).cast("bigint").alias("parquet_rows"),
        F.coalesce(F.max("db_rows"), F.lit(0)).cast("bigint").alias("db_rows"))
    return t.withColumn("coverage_pct", F.coalesce(F.round(
        F.try_divide(F.col("db_rows") * F.lit(100.0), F.when(F.col("parquet_rows") > 0, F.col("parquet_rows"))), 1),
        F.lit(0.0)))
