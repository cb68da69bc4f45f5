"""File-state control: append-only event log, latest state, planners, dashboard.

Parquet files cannot be updated in place, so the state machine is an event
log ``(year_month, file_name, status, ..., event_time, seq)``; the current
state is its latest event per file.  Every report here is a grouped
aggregate (map-side partial aggregation, so a month or status holding a third
of all files costs no more than any other) or a key join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiflow.functions.numbers import to_gb
from regiflow.functions.text import file_base, file_type
from regiflow.schema import DOWNLOADED_OR_LATER, STATUSES

FILE_KEY = ["year_month", "file_name"]


# --- event log ----------------------------------------------------------------

def latest_state(events: DataFrame, keys: list[str] = FILE_KEY,
                 order: list[str] = ("event_time", "seq")) -> DataFrame:
    """Latest event per key: ``max_by(row, (event_time, seq))``.

    A grouped aggregate, not a window: partial aggregation keeps one candidate
    per key per task before the shuffle, so a hot key never lands whole in one
    task.
    """
    rest = [c for c in events.columns if c not in keys]
    best = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order]))
    return events.groupBy(*keys).agg(best.alias("s")).select(*keys, "s.*")


def transition(current: DataFrame, to_status: str, allowed_from: list[str] | None = None,
               event_time: Column | None = None, **values: Column) -> tuple[DataFrame, DataFrame]:
    """Events moving files to ``to_status``; rows not allowed are returned as rejects.

    Returns ``(events, rejected)`` where rejected carries a ``reason``.
    """
    ok = F.lit(True) if allowed_from is None else F.col("status").isin(allowed_from)
    moved = current.where(ok).withColumns({"status": F.lit(to_status), **values,
                                           "event_time": event_time if event_time is not None else F.current_timestamp()})
    rejected = current.where(~ok).withColumn(
        "reason", F.concat(F.lit("status "), F.col("status"), F.lit(f" cannot move to {to_status}")))
    return moved, rejected


def append_events(events: DataFrame, path: str) -> None:
    """Append events to the log, partitioned by month (partition pruning)."""
    events.write.mode("append").partitionBy("year_month").parquet(path)


def read_log(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


# --- planners -----------------------------------------------------------------

def first_of_type(files: DataFrame, type_col: Column | None = None,
                  group: list[str] = ("year_month",)) -> DataFrame:
    """First file (by name) of each type, per group (``first_only`` runs)."""
    t = file_type("file_name") if type_col is None else type_col
    return (files.withColumn("file_type", t)
            .groupBy(*group, "file_type").agg(F.min("file_name").alias("file_name")))


def plan_downloads(current: DataFrame, retry_errors: bool = False) -> DataFrame:
    """Files to download: pending (and errored when ``retry_errors``)."""
    states = ["pending", "error"] if retry_errors else ["pending"]
    return current.where(F.col("status").isin(states))


def plan_transform(raw_files: DataFrame, current: DataFrame,
                   tracked: list[str] = DOWNLOADED_OR_LATER) -> DataFrame:
    """Raw files whose control row has a tracked status (semi join)."""
    return raw_files.join(current.where(F.col("status").isin(tracked)).select(*FILE_KEY), FILE_KEY, "left_semi")


# --- discovery ----------------------------------------------------------------

def register_new_months(listing: DataFrame, known: DataFrame, file_grain: bool = False) -> DataFrame:
    """New control rows (status ``pending``) for listed month folders.

    Month grain (default) skips a known month entirely; ``file_grain=True``
    also registers new files inside known months.
    """
    months = listing.where(F.col("year_month").rlike(r"^\d{4}-\d{2}$"))
    if file_grain:
        new = months.join(known.select(*FILE_KEY), FILE_KEY, "left_anti")
    else:
        new = months.join(known.select("year_month").distinct(), "year_month", "left_anti")
    return _pending(new)


def register_root_files(listing: DataFrame, known: DataFrame, root: str = "BASE") -> DataFrame:
    """New root archives (``.zip`` / ``.tar.gz``) at file grain."""
    name = F.lower(F.col("file_name"))
    files = listing.where((F.col("year_month") == root) & (name.endswith(".zip") | name.endswith(".tar.gz")))
    new = files.join(known.where(F.col("year_month") == root).select(*FILE_KEY), FILE_KEY, "left_anti")
    return _pending(new)


def _pending(df: DataFrame) -> DataFrame:
    return df.select("year_month", "file_name", F.col("size").alias("file_size_bytes"), "etag",
                     F.lit("pending").alias("status"))


# --- reports ------------------------------------------------------------------

def dashboard_month_status(current: DataFrame) -> DataFrame:
    """Files and bytes per (month, status), newest month first."""
    return (current.groupBy("year_month", "status")
            .agg(F.count(F.lit(1)).alias("count"), F.sum("file_size_bytes").alias("total_size_bytes"))
            .orderBy(F.col("year_month").desc(), "status"))


def dashboard_month(current: DataFrame, statuses: list[str] = STATUSES) -> DataFrame:
    """One row per month: totals and a count per status (fixed pivot, one pass)."""
    per_status = [F.count_if(F.col("status") == s).alias(f"n_{s}") for s in statuses]
    size = F.coalesce(F.sum("file_size_bytes"), F.lit(0)).cast("bigint")
    return (current.groupBy("year_month")
            .agg(F.count(F.lit(1)).alias("total_files"), size.alias("total_size_bytes"), *per_status)
            .withColumn("total_size_gb", to_gb(F.col("total_size_bytes")))
            .orderBy(F.col("year_month").desc()))


def dashboard_summary(current: DataFrame) -> DataFrame:
    """Global totals; always one row (zeros on an empty control table)."""
    months = dashboard_month(current).drop("total_size_gb")
    tot = F.coalesce(F.sum("total_size_bytes"), F.lit(0)).cast("bigint")
    return (months.agg(F.count(F.lit(1)).alias("total_months"),
                       F.coalesce(F.sum("total_files"), F.lit(0)).cast("bigint").alias("total_files"),
                       tot.alias("total_size_bytes"),
                       F.coalesce(F.sum("n_pending"), F.lit(0)).cast("bigint").alias("total_pending"),
                       F.coalesce(F.sum("n_loaded"), F.lit(0)).cast("bigint").alias("total_loaded"))
            .withColumn("total_size_gb", to_gb(F.col("total_size_bytes"))))


DETAIL_COLUMNS = ["year_month", "file_name", "file_size_bytes", "local_size_bytes", "local_hash", "etag", "status",
                  "download_progress", "discovered_at", "synced_at", "error_message"]


def month_detail(current: DataFrame, year_month: str | None = None) -> DataFrame:
    """Files of a month (or of every month) ordered by name."""
    df = current if year_month is None else current.where(F.col("year_month") == year_month)
    return df.select(*DETAIL_COLUMNS).orderBy("year_month", "file_name")


def progress_class(status: Column) -> Column:
    return (F.when(status == "downloading", "downloading")
            .when(status.isin(DOWNLOADED_OR_LATER), "completed")
            .when(status == "error", "errored")
            .otherwise("pending"))


def progress(current: DataFrame, year_month: str | None = None) -> DataFrame:
    """Per-file download progress with its class (downloading/completed/pending/errored)."""
    df = current if year_month is None else current.where(F.col("year_month") == year_month)
    return df.select(
        "year_month", "file_name", "status", progress_class(F.col("status")).alias("progress_class"),
        F.col("download_progress").alias("progress"), F.col("file_size_bytes").alias("remote_size_bytes"),
        "local_size_bytes",
        F.when(F.col("status") == "error", F.col("error_message")).alias("error_message"))


def progress_summary(current: DataFrame) -> DataFrame:
    """Counts per month of the four progress classes (zeros included)."""
    cls = progress_class(F.col("status"))
    return current.groupBy("year_month").agg(
        *[F.count_if(cls == c).alias(c) for c in ("downloading", "completed", "pending", "errored")])


def sync_type(c: Column) -> Column:
    """Type used by the download planner: the base name, not mapped to a layout."""
    return file_base(c)
