"""Queries: control table state, planners, discovery, dashboard, progress."""

from __future__ import annotations

from pyspark.sql import functions as F

from regiflow.functions.text import file_base
from regiflow.operators import control as C
from regiflow.plans import oracle as O
from regiflow.plans import standins as S
from regiflow.plans.catalog import register
from regiflow.schema import DOWNLOADED_OR_LATER, LAYOUTS, STATUSES

_CTL = f"({O.CONTROL}) c"
_TRACKED = O.in_list(DOWNLOADED_OR_LATER)


@register("latest_state", f"""
SELECT file_name, status, event_time, seq, value FROM (
  SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY event_time DESC, seq DESC) AS rn
  FROM ({O.CONTROL_EVENTS}) e) t WHERE rn = 1""", "WIN2 event log latest state")
def latest_state(spark, sf):
    return C.latest_state(S.control_events(spark, sf), keys=["file_name"])


@register("first_of_type", f"""
SELECT year_month, {O.file_type('file_name')} AS file_type, min(file_name) AS file_name
FROM {_CTL} WHERE status IN ({_TRACKED}) GROUP BY 1, 2""", "WIN1 transform first_only")
def first_of_type(spark, sf):
    files = S.control(spark, sf).where(F.col("status").isin(DOWNLOADED_OR_LATER))
    return C.first_of_type(files)


@register("first_pending_of_type", f"""
SELECT year_month, regexp_replace(file_name, '(?i)\\d*\\.zip|\\d*\\.tar\\.gz', '', 'g') AS file_type,
  min(file_name) AS file_name
FROM {_CTL} WHERE status = 'pending' GROUP BY 1, 2""", "WIN1 sync first_only CTL2")
def first_pending_of_type(spark, sf):
    files = C.plan_downloads(S.control(spark, sf))
    return C.first_of_type(files, type_col=file_base("file_name"))


@register("plan_downloads", f"""
SELECT year_month, file_name, file_size_bytes, status FROM {_CTL} WHERE status IN ('pending', 'error')""",
          "CTL2 FLT3 download plan with retry of errors")
def plan_downloads(spark, sf):
    return C.plan_downloads(S.control(spark, sf), retry_errors=True) \
        .select("year_month", "file_name", "file_size_bytes", "status")


@register("plan_files", f"""
SELECT s.key, s.year_month, s.file_name FROM (
  SELECT key, split_part(key, '/', 2) AS year_month, split_part(key, '/', 3) AS file_name
  FROM ({O.STORE}) st WHERE starts_with(key, 'raw/')) s
WHERE EXISTS (SELECT 1 FROM {_CTL} WHERE c.status IN ({_TRACKED})
              AND c.year_month = s.year_month AND c.file_name = s.file_name)""", "JN8 FLT3 transform plan")
def plan_files(spark, sf):
    st = S.store_inventory(spark, sf).where(F.col("key").startswith("raw/"))
    parts = F.split("key", "/")
    raw = st.select("key", parts.getItem(1).alias("year_month"), parts.getItem(2).alias("file_name"))
    return C.plan_transform(raw, S.control(spark, sf))


@register("register_new_months", f"""
SELECT year_month, file_name, size AS file_size_bytes, etag, 'pending' AS status
FROM ({O.REMOTE_LISTING}) r
WHERE regexp_matches(year_month, '^\\d{{4}}-\\d{{2}}$')
  AND year_month NOT IN (SELECT DISTINCT year_month FROM ({O.KNOWN_CONTROL}) k)""", "CTL1 JN6 FLT6 SET4")
def register_new_months(spark, sf):
    return C.register_new_months(S.remote_listing(spark, sf), S.known_control(spark, sf))


@register("register_new_files", f"""
SELECT year_month, file_name, size AS file_size_bytes, etag, 'pending' AS status
FROM ({O.REMOTE_LISTING}) r
WHERE regexp_matches(year_month, '^\\d{{4}}-\\d{{2}}$')
  AND NOT EXISTS (SELECT 1 FROM ({O.KNOWN_CONTROL}) k WHERE k.year_month = r.year_month AND k.file_name = r.file_name)""",
          "CTL1 file grain (D16 option)")
def register_new_files(spark, sf):
    return C.register_new_months(S.remote_listing(spark, sf), S.known_control(spark, sf), file_grain=True)


@register("register_root_files", f"""
SELECT year_month, file_name, size AS file_size_bytes, etag, 'pending' AS status
FROM ({O.REMOTE_LISTING}) r
WHERE year_month = 'BASE' AND (lower(file_name) LIKE '%.zip' OR lower(file_name) LIKE '%.tar.gz')
  AND NOT EXISTS (SELECT 1 FROM ({O.KNOWN_CONTROL}) k WHERE k.year_month = 'BASE' AND k.file_name = r.file_name)""",
          "CTL1 JN7 FLT7")
def register_root_files(spark, sf):
    return C.register_root_files(S.remote_listing(spark, sf), S.known_control(spark, sf))


@register("dashboard_month_status", f"""
SELECT year_month, status, count(*) AS count, CAST(sum(file_size_bytes) AS BIGINT) AS total_size_bytes
FROM {_CTL} GROUP BY 1, 2""", "AGG1 SRT2 CTL8")
def dashboard_month_status(spark, sf):
    return C.dashboard_month_status(S.control(spark, sf))


_PER_STATUS = ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS n_{s}" for s in STATUSES)


@register("dashboard_month", f"""
SELECT year_month, count(*) AS total_files, CAST(coalesce(sum(file_size_bytes), 0) AS BIGINT) AS total_size_bytes,
  {_PER_STATUS}, round(CAST(coalesce(sum(file_size_bytes), 0) AS DOUBLE) / 1073741824.0, 2) AS total_size_gb
FROM {_CTL} GROUP BY 1""", "AGG2 MTH1 CTL8")
def dashboard_month(spark, sf):
    return C.dashboard_month(S.control(spark, sf))


_SUMMARY_SQL = """
SELECT count(*) AS total_months, CAST(coalesce(sum(total_files), 0) AS BIGINT) AS total_files,
  CAST(coalesce(sum(total_size_bytes), 0) AS BIGINT) AS total_size_bytes,
  CAST(coalesce(sum(n_pending), 0) AS BIGINT) AS total_pending,
  CAST(coalesce(sum(n_loaded), 0) AS BIGINT) AS total_loaded,
  round(CAST(coalesce(sum(total_size_bytes), 0) AS DOUBLE) / 1073741824.0, 2) AS total_size_gb
FROM (SELECT year_month, count(*) AS total_files, coalesce(sum(file_size_bytes), 0) AS total_size_bytes,
        count(*) FILTER (WHERE status = 'pending') AS n_pending,
        count(*) FILTER (WHERE status = 'loaded') AS n_loaded
      FROM {src} GROUP BY 1) m"""


@register("dashboard_summary", _SUMMARY_SQL.format(src=_CTL), "AGG3 CTL8")
def dashboard_summary(spark, sf):
    return C.dashboard_summary(S.control(spark, sf))


@register("month_detail", f"""
SELECT year_month, file_name, file_size_bytes, local_size_bytes, local_hash, etag, status, download_progress,
  discovered_at, synced_at, error_message FROM {_CTL}""", "CTL6 SRT1")
def month_detail(spark, sf):
    return C.month_detail(S.control(spark, sf))


_CLASS = (f"CASE WHEN status = 'downloading' THEN 'downloading' WHEN status IN ({_TRACKED}) THEN 'completed' "
          "WHEN status = 'error' THEN 'errored' ELSE 'pending' END")


@register("progress_classes", f"""
SELECT year_month, file_name, status, {_CLASS} AS progress_class, download_progress AS progress,
  file_size_bytes AS remote_size_bytes, local_size_bytes,
  CASE WHEN status = 'error' THEN error_message END AS error_message
FROM {_CTL}""", "CTL7")
def progress_classes(spark, sf):
    return C.progress(S.control(spark, sf))


@register("progress_summary", f"""
SELECT year_month, {", ".join(f"count(*) FILTER (WHERE {_CLASS} = '{c}') AS {c}"
                              for c in ("downloading", "completed", "pending", "errored"))}
FROM {_CTL} GROUP BY 1""", "CTL7 summary AGG5")
def progress_summary(spark, sf):
    return C.progress_summary(S.control(spark, sf))


# --- state transitions (event generation from result logs) ----------------------

_STORE = f"({O.STORE}) s"


@register("download_events", f"""
SELECT c.year_month, c.file_name,
  CASE WHEN s.key IS NOT NULL THEN 'downloaded' ELSE 'error' END AS status,
  s.size_bytes AS local_size_bytes, s.content_hash AS local_hash,
  CASE WHEN s.key IS NOT NULL THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END AS download_progress,
  CASE WHEN s.key IS NULL THEN 'download failed: ' || c.file_name END AS error_message
FROM {_CTL} LEFT JOIN {_STORE} ON s.key = 'raw/' || c.year_month || '/' || c.file_name
WHERE c.status IN ('pending', 'downloading')""", "CTL3 transitions after download")
def download_events(spark, sf):
    from regiflow.functions.text import object_key
    cur = S.control(spark, sf).where(F.col("status").isin("pending", "downloading"))
    st = S.store_inventory(spark, sf).select(F.col("key").alias("s_key"), "size_bytes", "content_hash")
    j = cur.join(st, object_key("raw", F.col("year_month"), F.col("file_name")) == F.col("s_key"), "left")
    ok = F.col("s_key").isNotNull()
    return j.select("year_month", "file_name", F.when(ok, "downloaded").otherwise("error").alias("status"),
                    F.col("size_bytes").alias("local_size_bytes"), F.col("content_hash").alias("local_hash"),
                    F.when(ok, F.lit(100.0)).otherwise(F.lit(0.0)).alias("download_progress"),
                    F.when(~ok, F.concat(F.lit("download failed: "), F.col("file_name"))).alias("error_message"))


_MAPPED_SQL = f"{O.file_type('c.file_name')} IN ({O.in_list(list(LAYOUTS))})"


@register("transform_events", f"""
SELECT c.year_month, c.file_name,
  CASE WHEN NOT ({_MAPPED_SQL}) THEN 'downloaded' WHEN p.parquet_file IS NOT NULL THEN 'transformed' ELSE 'error' END
    AS status,
  CASE WHEN NOT ({_MAPPED_SQL}) THEN 'not_mapped' WHEN p.parquet_file IS NULL THEN 'no output written' END AS reason,
  p.row_count
FROM {_CTL} LEFT JOIN ({O.PROCESSED_STATS}) p ON p.year_month = c.year_month AND p.parquet_file = replace(c.file_name, '.zip', '.parquet')
WHERE c.status = 'downloaded'""", "CTL4 ENT7 transitions after transform")
def transform_events(spark, sf):
    from regiflow.functions.text import is_mapped, parquet_name
    cur = S.control(spark, sf).where(F.col("status") == "downloaded").select(
        "year_month", "file_name", F.col("status").alias("c_status"), parquet_name(F.col("file_name")).alias("parquet_name"))
    st = S.processed_stats(spark, sf).withColumn("parquet_name", F.col("parquet_file"))
    j = cur.join(st, ["year_month", "parquet_name"], "left")
    mapped = is_mapped(F.col("file_name"))
    return j.select("year_month", "file_name",
                    F.when(~mapped, F.col("c_status")).when(F.col("parquet_file").isNotNull(), "transformed")
                    .otherwise("error").alias("status"),
                    F.when(~mapped, "not_mapped").when(F.col("parquet_file").isNull(), "no output written")
                    .alias("reason"), "row_count")


@register("load_events", f"""
SELECT c.year_month, c.file_name, 'loaded' AS status, p.row_count
FROM {_CTL} JOIN ({O.PROCESSED_STATS}) p ON p.year_month = c.year_month AND p.parquet_file = replace(c.file_name, '.zip', '.parquet')
WHERE c.status = 'transformed' AND {_MAPPED_SQL}""", "CTL5 only files that loaded (D7)")
def load_events(spark, sf):
    from regiflow.functions.text import is_mapped, parquet_name
    cur = S.control(spark, sf).where((F.col("status") == "transformed") & is_mapped(F.col("file_name")))
    st = S.processed_stats(spark, sf).withColumnRenamed("parquet_file", "parquet_name")
    j = cur.withColumn("parquet_name", parquet_name(F.col("file_name"))).join(st, ["year_month", "parquet_name"])
    return j.select("year_month", "file_name", F.lit("loaded").alias("status"), "row_count")


@register("resolve_sources", f"""
SELECT year_month, file_name, location, size_bytes, origin FROM (
  SELECT *, row_number() OVER (PARTITION BY year_month, file_name ORDER BY rank) AS rn FROM (
    SELECT year_month, file_name, 'local:raw/' || year_month || '/' || file_name AS location, local_size_bytes AS size_bytes,
      0 AS rank, 'local' AS origin
    FROM {_CTL} WHERE status IN ({_TRACKED}) AND c.priority IN ('1-URGENT', '2-HIGH')
    UNION ALL
    SELECT split_part(key, '/', 2), split_part(key, '/', 3), 'store:' || key, size_bytes, 1, 'store'
    FROM {_STORE} WHERE starts_with(key, 'raw/')) b) r
WHERE rn = 1""", "SRC12 local-first fallback to store")
def resolve_sources(spark, sf):
    from regiflow.sources.resolve import resolve_sources as rs
    c = S.control(spark, sf).where(F.col("status").isin(DOWNLOADED_OR_LATER) & F.col("priority").isin("1-URGENT", "2-HIGH"))
    local = c.select("year_month", "file_name", F.concat(F.lit("local:raw/"), F.col("year_month"), F.lit("/"),
                                           F.col("file_name")).alias("location"),
                     F.col("local_size_bytes").alias("size_bytes"))
    st = S.store_inventory(spark, sf).where(F.col("key").startswith("raw/"))
    store = st.select(F.split("key", "/").getItem(1).alias("year_month"), F.split("key", "/").getItem(2).alias("file_name"),
                      F.concat(F.lit("store:"), F.col("key")).alias("location"), "size_bytes")
    return rs(local, store)


@register("iso_timestamps", f"""
SELECT file_name, strftime(discovered_at, '%Y-%m-%dT%H:%M:%S') AS discovered_at_iso,
  strftime(synced_at, '%Y-%m-%dT%H:%M:%S') AS synced_at_iso FROM {_CTL}""", "DAT2 ISO text")
def iso_timestamps(spark, sf):
    from regiflow.functions.dates import iso_text
    c = S.control(spark, sf)
    return c.select("file_name", iso_text(F.col("discovered_at")).alias("discovered_at_iso"),
                    iso_text(F.col("synced_at")).alias("synced_at_iso"))
