"""Gap analysis between the object store and the control table (SET1-3, INT4, AGG13).

Months are compared per layer: ``raw/2025-06/x.zip`` belongs to month
``2025-06``.  ``compat=True`` keeps the reference grouping key
(``raw/2025-06``), which never equals a control month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiflow.functions.formats import human_bytes
from regiflow.functions.text import layer_of_key, month_of_key


def store_by_prefix(store: DataFrame, compat: bool = False) -> DataFrame:
    """Objects and bytes per store month (partial aggregation, no object lists)."""
    return (store.groupBy(month_of_key(F.col("key"), compat).alias("month"))
            .agg(F.count(F.lit(1)).alias("objects"), F.sum("size_bytes").cast("bigint").alias("size_bytes"))
            .withColumn("size_human", human_bytes(F.col("size_bytes"))))


def store_objects(store: DataFrame, compat: bool = False) -> DataFrame:
    """Flat object list with month and layer columns (the per-month object lists)."""
    return store.select(month_of_key(F.col("key"), compat).alias("month"), layer_of_key(F.col("key")).alias("layer"),
                        "key", "size_bytes", human_bytes(F.col("size_bytes")).alias("size_human"))


def _control_months(control: DataFrame) -> DataFrame:
    return control.select(F.col("year_month").alias("month")).distinct()


def gap_full(control: DataFrame, store: DataFrame, compat: bool = False) -> DataFrame:
    """All months of either side in one pass: full outer join + class."""
    c = _control_months(control).withColumn("in_control", F.lit(True))
    s = store_by_prefix(store, compat).withColumn("in_store", F.lit(True))
    j = c.join(s, "month", "full_outer")
    in_c = F.coalesce(F.col("in_control"), F.lit(False))
    in_s = F.coalesce(F.col("in_store"), F.lit(False))
    cls = F.when(in_c & in_s, "in_both").when(in_c, "only_in_db").otherwise("only_in_s3")
    return j.select("month", in_c.alias("in_control"), in_s.alias("in_store"), cls.alias("gap_class"),
                    F.coalesce(F.col("objects"), F.lit(0)).cast("bigint").alias("store_objects"),
                    F.coalesce(F.col("size_bytes"), F.lit(0)).cast("bigint").alias("store_bytes"))


def months_in_both(full: DataFrame) -> DataFrame:
    return full.where(F.col("gap_class") == "in_both").select("month")


def months_only_in_control(full: DataFrame) -> DataFrame:
    return full.where(F.col("gap_class") == "only_in_db").select("month")


def months_only_in_store(full: DataFrame) -> DataFrame:
    """Store-only months with their object count and bytes."""
    return full.where(F.col("gap_class") == "only_in_s3").select(
        "month", F.col("store_objects").alias("objects"), F.col("store_bytes").alias("size_bytes"),
        human_bytes(F.col("store_bytes")).alias("size_human"))


def gap_summary(full: DataFrame) -> DataFrame:
    return full.agg(
        F.count_if(F.col("gap_class") == "in_both").alias("months_in_both"),
        F.count_if(F.col("gap_class") == "only_in_db").alias("months_only_in_db"),
        F.count_if(F.col("gap_class") == "only_in_s3").alias("months_only_in_s3"),
        F.sum("store_objects").cast("bigint").alias("s3_total_objects"),
        human_bytes(F.sum("store_bytes")).alias("s3_total_size_human"))


def list_objects(store: DataFrame, prefix: str = "", max_keys: int = 1000, start_after: str | None = None) -> DataFrame:
    """One page of the objects under ``prefix`` in key order: at most ``max_keys`` (1..1000) keys
    after ``start_after``; ``is_truncated`` tells that more follow, from the page's last key on."""
    if not 1 <= max_keys <= 1000:
        raise ValueError("max_keys must be within 1..1000")
    found = store.where(F.col("key").startswith(prefix))
    if start_after is not None:
        found = found.where(F.col("key") > F.lit(start_after))
    page = found.select("key", "size_bytes", "last_modified", "etag").orderBy("key").limit(max_keys + 1)
    keys = page.agg(F.array_sort(F.collect_list(F.struct("key", "size_bytes", "last_modified", "etag"))).alias("page"))    # at most 1001
    shown = keys.select(F.explode(F.slice("page", 1, max_keys)).alias("o"), (F.size("page") > max_keys).alias("is_truncated"))
    return shown.select("o.*", human_bytes(F.col("o.size_bytes")).alias("size_human"), "is_truncated")


def list_totals(store: DataFrame, prefix: str = "") -> DataFrame:
    """One row for all objects under ``prefix``: their number and size, as ``list_objects`` pages through them."""
    found = store.where(F.col("key").startswith(prefix))
    size = F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("bigint")
    return found.agg(F.count(F.lit(1)).alias("total_objects"), size.alias("total_size_bytes"), human_bytes(size).alias("total_size_human"))


def object_metadata(store: DataFrame, key: str) -> DataFrame:
    return store.where(F.col("key") == key).select("key", "size_bytes", "last_modified", "etag")
