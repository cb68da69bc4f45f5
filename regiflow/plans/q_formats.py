"""Queries: human-readable sizes, durations, percentages, transfer rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from regiflow.functions.formats import eta_text, human_bytes, percent_text
from regiflow.functions.numbers import progress_pct
from regiflow.functions.text import strip_quotes, truncate
from regiflow.plans import oracle as O
from regiflow.plans import standins as S
from regiflow.plans.catalog import register
from regiflow.schema import DOWNLOADED_OR_LATER, ERROR_MESSAGE_CHARS, ETA_PLACEHOLDER

_CTL = f"({O.CONTROL}) c"


@register("human_bytes", f"""
SELECT file_name, file_size_bytes, {O.human_bytes('file_size_bytes')} AS size_human,
  {O.human_bytes('CAST(file_size_bytes AS DOUBLE) * 1e9')} AS size_human_large,
  {O.human_bytes('file_id')} AS id_human
FROM {_CTL}""", "STR13 MTH1")
def human_bytes_q(spark, sf):
    c = S.control(spark, sf)
    return c.select("file_name", "file_size_bytes", human_bytes(F.col("file_size_bytes")).alias("size_human"),
                    human_bytes(F.col("file_size_bytes").cast("double") * F.lit(1e9)).alias("size_human_large"),
                    human_bytes(F.col("file_id")).alias("id_human"))


_SECS = "((file_id % 90000) - 1000) * CAST(1.5 AS DOUBLE)"
_W = f"CAST(floor({_SECS}) AS BIGINT)"


@register("eta_text", f"""
SELECT file_name, {_SECS} AS seconds,
  CASE WHEN {_SECS} < 0 OR {_SECS} > 86400 THEN '{ETA_PLACEHOLDER}'
       WHEN {_W} // 3600 > 0 THEN CAST({_W} // 3600 AS VARCHAR) || 'h' || lpad(CAST(({_W} % 3600) // 60 AS VARCHAR), 2, '0')
            || 'm' || lpad(CAST({_W} % 60 AS VARCHAR), 2, '0') || 's'
       WHEN ({_W} % 3600) // 60 > 0 THEN CAST(({_W} % 3600) // 60 AS VARCHAR) || 'm'
            || lpad(CAST({_W} % 60 AS VARCHAR), 2, '0') || 's'
       ELSE CAST({_W} % 60 AS VARCHAR) || 's' END AS eta
FROM {_CTL}""", "STR14")
def eta_text_q(spark, sf):
    c = S.control(spark, sf)
    secs = ((F.col("file_id") % 90000) - 1000) * F.lit(1.5)
    return c.select("file_name", secs.alias("seconds"), eta_text(secs).alias("eta"))


@register("percent_text", f"""
SELECT file_name,
  CASE WHEN local_size_bytes IS NULL OR file_size_bytes IS NULL THEN NULL WHEN file_size_bytes = 0 THEN 'N/A'
       ELSE printf('%.1f%%', 100.0 * local_size_bytes / file_size_bytes) END AS local_pct
FROM {_CTL}""", "STR15")
def percent_text_q(spark, sf):
    c = S.control(spark, sf)
    return c.select("file_name", percent_text(F.col("local_size_bytes"), F.col("file_size_bytes")).alias("local_pct"))


@register("transfer_rates", f"""
SELECT file_name, secs AS elapsed_seconds,
  round(local_size_bytes / 1048576.0 / CASE WHEN secs > 0 THEN secs END, 3) AS rate_mb_s,
  coalesce(round(local_size_bytes * 100.0 / CASE WHEN file_size_bytes > 0 THEN file_size_bytes END, 1), 0.0)
    AS progress_pct,
  round(CAST(local_size_bytes AS DOUBLE) / 1048576.0, 1) AS local_mb,
  round(CAST(local_size_bytes AS DOUBLE) / 1073741824.0, 2) AS local_gb
FROM (SELECT *, date_diff('second', discovered_at, synced_at) AS secs FROM {_CTL}
      WHERE status IN ({O.in_list(DOWNLOADED_OR_LATER)})) t""", "MTH1 MTH2")
def transfer_rates(spark, sf):
    c = S.control(spark, sf).where(F.col("status").isin(DOWNLOADED_OR_LATER))
    secs = F.timestamp_diff("SECOND", F.col("discovered_at"), F.col("synced_at"))
    return c.select(
        "file_name", secs.alias("elapsed_seconds"),
        F.round(F.try_divide(F.col("local_size_bytes") / F.lit(1048576.0), F.when(secs > 0, secs)), 3).alias("rate_mb_s"),
        progress_pct(F.col("local_size_bytes"), F.col("file_size_bytes")).alias("progress_pct"),
        F.round(F.col("local_size_bytes") / F.lit(1048576.0), 1).alias("local_mb"),
        F.round(F.col("local_size_bytes") / F.lit(1073741824.0), 2).alias("local_gb"))


@register("error_messages", f"""
SELECT file_name, substr(error_message, 1, {ERROR_MESSAGE_CHARS}) AS error_message,
  regexp_replace('"' || etag || '"', '^"+|"+$', '', 'g') AS etag_clean
FROM {_CTL} WHERE status = 'error'""", "STR11 STR12")
def error_messages(spark, sf):
    c = S.control(spark, sf).where(F.col("status") == "error")
    quoted = F.concat(F.lit('"'), F.col("etag"), F.lit('"'))
    return c.select("file_name", truncate(F.col("error_message"), ERROR_MESSAGE_CHARS).alias("error_message"),
                    strip_quotes(quoted).alias("etag_clean"))
