"""Queries: integrity, remote/local diff, layer checks, publish plan, gaps, coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from regiflow.operators import gaps as G
from regiflow.operators import integrity as I
from regiflow.plans import oracle as O
from regiflow.plans import standins as S
from regiflow.plans.catalog import register
from regiflow.schema import DOWNLOADED_OR_LATER, LAYOUTS, TRANSFORMED_OR_LATER
from regiflow.sinks.tables import unprocessed_inputs as unprocessed

START_AFTER = "raw/1992-03/"      # the listing page shown begins after this key

_CTL = f"({O.CONTROL})"
_STORE = f"({O.STORE})"
_STATS = f"({O.PROCESSED_STATS})"
_TRACKED = O.in_list(DOWNLOADED_OR_LATER)
_DONE = O.in_list(TRANSFORMED_OR_LATER)
_RAWKEY = "'raw/' || c.year_month || '/' || c.file_name"


@register("verify_integrity", f"""
SELECT * FROM (
  SELECT c.year_month, c.file_name,
    CASE WHEN s.key IS NULL THEN 'missing_in_s3'
         WHEN c.local_size_bytes IS NOT NULL AND c.local_size_bytes <> 0 AND s.size_bytes <> c.local_size_bytes
           THEN 'size_mismatch'
         WHEN c.local_hash IS NOT NULL AND c.local_hash <> '' AND s.content_hash IS NULL THEN 's3_read_error'
         WHEN c.local_hash IS NOT NULL AND c.local_hash <> '' AND s.content_hash <> c.local_hash THEN 'hash_mismatch'
    END AS issue,
    c.local_size_bytes AS recorded_size_bytes, s.size_bytes AS store_size_bytes
  FROM {_CTL} c LEFT JOIN {_STORE} s ON s.key = {_RAWKEY}
  WHERE c.status IN ({_TRACKED})) t
WHERE issue IS NOT NULL""", "INT1 JN3 HSH1")
def verify_integrity(spark, sf):
    return I.verify_integrity(S.control(spark, sf), S.store_inventory(spark, sf), full_check=True)


_DIFF_SQL = f"""
SELECT c.year_month, c.file_name, c.status, c.etag AS remote_etag, c.local_hash AS local_hash_sha256,
  c.file_size_bytes AS remote_size_bytes, c.local_size_bytes, s.size_bytes AS actual_s3_size,
  CASE WHEN c.status = 'pending' THEN 'never_downloaded'
       WHEN c.local_hash IS NULL OR c.local_hash = '' THEN 'missing_hash'
       WHEN s.key IS NULL THEN 'file_missing'
       WHEN c.file_size_bytes IS NOT NULL AND c.file_size_bytes <> 0 AND s.size_bytes <> c.file_size_bytes
         THEN 'size_mismatch'
       WHEN r.etag IS NOT NULL AND r.etag <> c.etag THEN 'changed_remote'
       ELSE 'synced' END AS diff_class
FROM {_CTL} c
LEFT JOIN {_STORE} s ON s.key = {_RAWKEY}
LEFT JOIN ({O.REMOTE_LISTING}) r ON r.year_month = c.year_month AND r.file_name = c.file_name"""


@register("remote_local_diff", _DIFF_SQL, "INT2 JN3")
def remote_local_diff(spark, sf):
    return I.remote_local_diff(S.control(spark, sf), S.store_inventory(spark, sf), S.remote_listing(spark, sf))


@register("diff_summary", f"""
SELECT year_month, count(*) AS total_files,
  {", ".join(f"count(*) FILTER (WHERE diff_class = '{c}') AS {c}" for c in I.DIFF_CLASSES)}
FROM ({_DIFF_SQL}) d GROUP BY 1""", "INT2 summary AGG5")
def diff_summary(spark, sf):
    return I.diff_summary(remote_local_diff(spark, sf))


def _layer_sql(layer: str) -> str:
    if layer == "raw":
        recs = f"SELECT year_month, file_name, local_size_bytes AS expected_size FROM {_CTL} c WHERE status IN ({_TRACKED})"
    else:
        recs = (f"SELECT year_month, replace(file_name, '.zip', '.parquet') AS file_name, "
                f"CAST(NULL AS BIGINT) AS expected_size FROM {_CTL} c WHERE status IN ({_DONE})")
    return f"""
SELECT year_month, file_name, expected_size, s3_key, s3_exists, s3_size, size_match,
  CASE WHEN NOT s3_exists THEN 'missing_in_s3' WHEN size_match THEN 'ok' ELSE 'size_mismatch' END AS status
FROM (
  SELECT r.year_month, r.file_name, r.expected_size, r.s3_key, s.key IS NOT NULL AS s3_exists,
    s.size_bytes AS s3_size,
    CASE WHEN s.key IS NULL THEN NULL WHEN r.expected_size IS NULL THEN TRUE
         ELSE r.expected_size = s.size_bytes END AS size_match
  FROM (SELECT *, '{layer}/' || year_month || '/' || file_name AS s3_key FROM ({recs}) x) r
  LEFT JOIN {_STORE} s ON s.key = r.s3_key) t"""


@register("layer_check_raw", _layer_sql("raw"), "INT3 raw layer")
def layer_check_raw(spark, sf):
    return I.layer_check(S.control(spark, sf), S.store_inventory(spark, sf), "raw")


@register("layer_check_processed", _layer_sql("processed"), "INT3 processed layer")
def layer_check_processed(spark, sf):
    return I.layer_check(S.control(spark, sf), S.store_inventory(spark, sf), "processed")


@register("layer_summary", f"""
SELECT year_month, count(*) FILTER (WHERE status = 'ok') AS ok,
  count(*) FILTER (WHERE status = 'missing_in_s3') AS missing_in_s3,
  count(*) FILTER (WHERE status = 'size_mismatch') AS size_mismatch, count(*) AS total
FROM ({_layer_sql('raw')}) t GROUP BY 1""", "INT3 summary AGG5")
def layer_summary(spark, sf):
    return I.layer_summary(layer_check_raw(spark, sf))


_UPLOAD_SQL = f"""
SELECT l.key, l.local_size_bytes, s.size_bytes AS store_size_bytes,
  CASE WHEN s.key IS NOT NULL AND s.size_bytes = l.local_size_bytes THEN 'skip' ELSE 'upload' END AS action
FROM (SELECT {_RAWKEY} AS key, local_size_bytes FROM {_CTL} c
      WHERE status IN ({_TRACKED}) AND local_size_bytes IS NOT NULL) l
LEFT JOIN {_STORE} s ON s.key = l.key"""


@register("upload_plan", _UPLOAD_SQL, "SNK11 INC1 skip same-size objects")
def upload_plan(spark, sf):
    return I.upload_plan(I.local_raw_files(S.control(spark, sf)), S.store_inventory(spark, sf))


@register("upload_summary", f"""
SELECT count(*) FILTER (WHERE action = 'upload') AS uploaded, count(*) FILTER (WHERE action = 'skip') AS skipped,
  CAST(coalesce(sum(local_size_bytes) FILTER (WHERE action = 'upload'), 0) AS BIGINT) AS upload_bytes
FROM ({_UPLOAD_SQL}) p""", "SNK11 AGG14 counters")
def upload_summary(spark, sf):
    return I.upload_summary(upload_plan(spark, sf))


# --- gap analysis ---------------------------------------------------------------

_SMONTH = O.month_of_key("key")
_BY_PREFIX = f"""
SELECT month, objects, size_bytes, {O.human_bytes('size_bytes')} AS size_human FROM (
  SELECT {_SMONTH} AS month, count(*) AS objects, CAST(sum(size_bytes) AS BIGINT) AS size_bytes
  FROM {_STORE} s GROUP BY 1) t"""


@register("store_by_prefix", _BY_PREFIX, "AGG13 STR9 STR13")
def store_by_prefix(spark, sf):
    return G.store_by_prefix(S.store_inventory(spark, sf))


@register("store_by_prefix_compat", f"""
SELECT month, objects, size_bytes, {O.human_bytes('size_bytes')} AS size_human FROM (
  SELECT {O.month_of_key('key', compat=True)} AS month, count(*) AS objects, CAST(sum(size_bytes) AS BIGINT) AS size_bytes
  FROM {_STORE} s GROUP BY 1) t""", "AGG13 STR9 reference grouping key")
def store_by_prefix_compat(spark, sf):
    return G.store_by_prefix(S.store_inventory(spark, sf), compat=True)


@register("store_objects", f"""
SELECT {_SMONTH} AS month,
  CASE WHEN len(string_split(key, '/')) >= 3 AND split_part(key, '/', 1) IN ('raw', 'processed')
       THEN split_part(key, '/', 1) END AS layer,
  key, size_bytes, {O.human_bytes('size_bytes')} AS size_human FROM {_STORE} s""", "AGG13 object lists (flat)")
def store_objects(spark, sf):
    return G.store_objects(S.store_inventory(spark, sf))


_CMONTHS = f"SELECT DISTINCT year_month AS month FROM {_CTL} c"
_SMONTHS = f"SELECT DISTINCT {_SMONTH} AS month FROM {_STORE} s"


@register("gap_both", f"{_CMONTHS} INTERSECT {_SMONTHS}", "SET1 INT4")
def gap_both(spark, sf):
    return G.months_in_both(gap_full(spark, sf))


@register("gap_only_control", f"{_CMONTHS} EXCEPT {_SMONTHS}", "SET2 INT4")
def gap_only_control(spark, sf):
    return G.months_only_in_control(gap_full(spark, sf))


@register("gap_only_store", f"""
SELECT * FROM ({_BY_PREFIX}) b WHERE month IN (SELECT month FROM ({_SMONTHS} EXCEPT {_CMONTHS}) x)""",
          "SET3 INT4")
def gap_only_store(spark, sf):
    return G.months_only_in_store(gap_full(spark, sf))


_GAP_FULL = f"""
SELECT coalesce(c.month, b.month) AS month, c.month IS NOT NULL AS in_control, b.month IS NOT NULL AS in_store,
  CASE WHEN c.month IS NOT NULL AND b.month IS NOT NULL THEN 'in_both'
       WHEN c.month IS NOT NULL THEN 'only_in_db' ELSE 'only_in_s3' END AS gap_class,
  CAST(coalesce(b.objects, 0) AS BIGINT) AS store_objects, CAST(coalesce(b.size_bytes, 0) AS BIGINT) AS store_bytes
FROM ({_CMONTHS}) c FULL OUTER JOIN ({_BY_PREFIX}) b ON c.month = b.month"""


@register("gap_full", _GAP_FULL, "SET1-3 INT4 full outer")
def gap_full(spark, sf):
    return G.gap_full(S.control(spark, sf), S.store_inventory(spark, sf))


@register("gap_summary", f"""
SELECT count(*) FILTER (WHERE gap_class = 'in_both') AS months_in_both,
  count(*) FILTER (WHERE gap_class = 'only_in_db') AS months_only_in_db,
  count(*) FILTER (WHERE gap_class = 'only_in_s3') AS months_only_in_s3,
  CAST(sum(store_objects) AS BIGINT) AS s3_total_objects,
  {O.human_bytes('CAST(sum(store_bytes) AS BIGINT)')} AS s3_total_size_human
FROM ({_GAP_FULL}) g""", "INT4 summary")
def gap_summary(spark, sf):
    return G.gap_summary(gap_full(spark, sf))


@register("list_objects", f"""
SELECT key, size_bytes, last_modified, etag, {O.human_bytes('size_bytes')} AS size_human,
  (SELECT count(*) FROM {_STORE} s WHERE starts_with(key, 'raw/') AND key > '{START_AFTER}') > 1000 AS is_truncated
FROM {_STORE} s WHERE starts_with(key, 'raw/') AND key > '{START_AFTER}'
ORDER BY key LIMIT 1000""", "SRC8 SRC10 prefix listing page after a key, with truncation")
def list_objects(spark, sf):
    return G.list_objects(S.store_inventory(spark, sf), "raw/", 1000, START_AFTER)


@register("object_metadata", f"""
SELECT key, size_bytes, last_modified, etag FROM {_STORE} s
WHERE key = (SELECT max(key) FROM {_STORE} s WHERE starts_with(key, 'processed/'))""", "SRC9 one object's metadata")
def object_metadata(spark, sf):
    store = S.store_inventory(spark, sf)
    last = store.where(F.col("key").startswith("processed/")).agg(F.max("key").alias("key"))
    return store.join(last, "key", "left_semi").select("key", "size_bytes", "last_modified", "etag")


@register("unprocessed_inputs", f"""
SELECT c.year_month, c.file_name FROM {_CTL} c
WHERE NOT EXISTS (SELECT 1 FROM {_STORE} s WHERE starts_with(key, 'processed/') AND split_part(key, '/', 2) = c.year_month
                  AND split_part(key, '/', 3) = replace(c.file_name, '.zip', '.parquet'))""", "SNK3 anti join by month and name")
def unprocessed_inputs(spark, sf):
    done = S.store_inventory(spark, sf).where(F.col("key").startswith("processed/"))
    return unprocessed(S.control(spark, sf).select("year_month", "file_name"), done)


# --- transform / load status -----------------------------------------------------

_TSTATUS = f"""
SELECT c.year_month, c.file_name, {O.file_type('c.file_name')} AS file_type,
  {O.file_type('c.file_name')} IN ({O.in_list(list(LAYOUTS))}) AS mapped,
  CASE WHEN c.local_size_bytes IS NOT NULL AND c.local_size_bytes <> 0
       THEN round(CAST(c.local_size_bytes AS DOUBLE) / 1048576.0, 1) END AS zip_size_mb,
  p.parquet_file IS NOT NULL AS parquet_exists_local,
  round(CAST(p.size_bytes AS DOUBLE) / 1048576.0, 1) AS parquet_size_mb_local,
  p.size_bytes AS parquet_size_bytes, p.row_count,
  CASE WHEN NOT ({O.file_type('c.file_name')} IN ({O.in_list(list(LAYOUTS))})) THEN 'not_mapped'
       ELSE c.status END AS status
FROM {_CTL} c LEFT JOIN {_STATS} p ON p.year_month = c.year_month AND p.parquet_file = replace(c.file_name, '.zip', '.parquet')
WHERE c.status IN ({_TRACKED})"""


@register("transform_status", _TSTATUS, "INT5 JN4 SRC5")
def transform_status(spark, sf):
    return I.transform_status(S.control(spark, sf), S.processed_stats(spark, sf))


@register("transform_summary", f"""
SELECT year_month, count(*) AS total_zips,
  count(*) FILTER (WHERE status IN ({_DONE})) AS transformed,
  count(*) FILTER (WHERE status = 'downloaded') AS pending,
  count(*) FILTER (WHERE status = 'not_mapped') AS not_mapped,
  CAST(coalesce(sum(row_count), 0) AS BIGINT) AS total_rows_local,
  round(CAST(coalesce(sum(parquet_size_bytes), 0) AS DOUBLE) / 1073741824.0, 2) AS total_parquet_gb_local
FROM ({_TSTATUS}) t GROUP BY 1""", "INT5 summary AGG5 AGG14")
def transform_summary(spark, sf):
    return I.transform_summary(transform_status(spark, sf))


_COUNTS = f"""
SELECT {O.table_name('p.parquet_file')} AS table_name, CAST(sum(p.row_count) AS BIGINT) AS db_rows
FROM {_STATS} p JOIN (SELECT year_month, replace(file_name, '.zip', '.parquet') AS parquet_file FROM {_CTL} c
                       WHERE status = 'loaded') l ON l.year_month = p.year_month AND l.parquet_file = p.parquet_file
GROUP BY 1"""

_LSTATUS = f"""
SELECT r.year_month, r.file_name, r.table_name, p.row_count AS parquet_rows, t.db_rows,
  CASE WHEN t.db_rows > 0 THEN 'loaded' ELSE 'pending' END AS status
FROM (SELECT year_month, file_name, {O.table_name('file_name')} AS table_name
      FROM (SELECT year_month, replace(file_name, '.zip', '.parquet') AS file_name FROM {_CTL} c
            WHERE status IN ({_DONE})) x) r
LEFT JOIN {_STATS} p ON p.year_month = r.year_month AND p.parquet_file = r.file_name
LEFT JOIN ({_COUNTS}) t ON t.table_name = r.table_name"""


@register("load_status", _LSTATUS, "INT6 JN5 SNK10")
def load_status(spark, sf):
    c = S.control(spark, sf)
    st = S.processed_stats(spark, sf)
    return I.load_status(c, st, I.table_counts(c, st))


@register("load_summary", f"""
SELECT year_month, CAST(sum(parts) AS BIGINT) AS total_parquets, CAST(sum(parquet_rows) AS BIGINT) AS total_parquet_rows,
  CAST(sum(db_rows) AS BIGINT) AS total_db_rows, count(*) FILTER (WHERE db_rows > 0) AS tables_with_data,
  count(*) AS tables_total,
  coalesce(round(sum(db_rows) * 100.0 / CASE WHEN sum(parquet_rows) > 0 THEN sum(parquet_rows) END, 1), 0.0)
    AS coverage_pct
FROM (SELECT year_month, table_name, count(*) AS parts, coalesce(sum(parquet_rows), 0) AS parquet_rows,
        coalesce(max(db_rows), 0) AS db_rows FROM ({_LSTATUS}) s GROUP BY 1, 2) t
GROUP BY 1""", "INT6 AGG6 AGG7 (D8 once per table)")
def load_summary(spark, sf):
    return I.load_summary(load_status(spark, sf))


@register("coverage", f"""
SELECT table_name, parquet_rows, db_rows,
  coalesce(round(db_rows * 100.0 / CASE WHEN parquet_rows > 0 THEN parquet_rows END, 1), 0.0) AS coverage_pct
FROM (SELECT table_name, CAST(coalesce(sum(parquet_rows), 0) AS BIGINT) AS parquet_rows,
        CAST(coalesce(max(db_rows), 0) AS BIGINT) AS db_rows FROM ({_LSTATUS}) s GROUP BY 1) t""", "AGG7 coverage")
def coverage(spark, sf):
    return I.coverage(load_status(spark, sf))
