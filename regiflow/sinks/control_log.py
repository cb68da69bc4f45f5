"""The control log as a published table: appended events, compacted into a snapshot (WIN2, CTL8).

Events are appended as folders of runs.  ``compact`` replaces what it has read by the
latest event of each file; events that came meanwhile stay as a tail, so the latest state
of snapshot and tail is that of the whole log, and reading it costs the files known and
the events since, not all that ever happened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regiflow.operators.control import FILE_KEY, latest_state
from regiflow.sinks import transaction

TABLE = "control_log"


def append(spark: SparkSession, root: str, events: DataFrame) -> int:
    """Add events; returns the manifest's number."""
    run = transaction.Run(spark, root)
    run.stage(TABLE, events)
    return run.publish()


def events(spark: SparkSession, root: str) -> DataFrame | None:
    """Snapshot and tail."""
    return transaction.read_table(spark, root, TABLE)


def state(spark: SparkSession, root: str, keys: list[str] = FILE_KEY) -> DataFrame | None:
    """Latest state per file."""
    log = events(spark, root)
    return None if log is None else latest_state(log, keys)


def compact(spark: SparkSession, root: str, keys: list[str] = FILE_KEY) -> int:
    """Replace the log read by its latest events; returns the manifest's number."""
    run = transaction.Run(spark, root)
    log = transaction.read_table(spark, root, TABLE, run.start["version"] or None)
    if log is None:
        run.abort()
        return run.start["version"]
    run.stage(TABLE, latest_state(log, keys).select(*log.columns), "compact")
    return run.publish()
