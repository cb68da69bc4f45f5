"""Incremental ingest with Structured Streaming (INC1, SNK3).

A file-source stream over the raw folder of one entity remembers the files it
has processed in its checkpoint, so each run (``trigger(availableNow=True)``)
transforms only the files that arrived since the last run and then stops;
re-running with no new files adds nothing.  Each micro-batch is written as
silver Parquet and, through ``foreachBatch``, one ``transformed`` control
event per source file is appended to the event log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiflow.operators.rules import normalize
from regiflow.schema import CONTROL_EVENT_SCHEMA, LAYOUTS, raw_schema
from regiflow.sources.csv import CORRUPT, csv_options, split_quarantine


def raw_stream(spark: SparkSession, folder: str, entity: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming raw text of one entity (schema declared, never inferred)."""
    if entity not in LAYOUTS:
        raise ValueError(f"unknown entity {entity!r}")
    reader = spark.readStream.schema(raw_schema(entity).add(T.StructField(CORRUPT, T.StringType())))
    for k, v in csv_options().items():
        reader = reader.option(k, v)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.csv(folder).withColumn("source_file", F.col("_metadata.file_name"))


def write_micro_batch(batch: DataFrame, batch_id: int, out_path: str, events_path: str | None = None,
                      year_month: str | None = None) -> int:
    """Write one micro-batch idempotently; returns the number of good rows.

    ``foreachBatch`` is at-least-once: after a failure the same ``batch_id``
    can run again.  Every output of a batch goes to its own ``batch=<id>``
    folder written with overwrite, so a re-run replaces that batch's files
    instead of appending duplicates.
    """
    from pyspark import StorageLevel
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        good, bad = split_quarantine(batch)
        parts = ["year_month"] if "year_month" in good.columns else []
        w = good.write.mode("overwrite").option("compression", "snappy")
        (w.partitionBy(*parts) if parts else w).parquet(f"{out_path.rstrip('/')}/batch={batch_id}")
        bad.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}_quarantine/batch={batch_id}")
        if events_path is not None:
            ev = batch.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(year_month or "").alias("year_month"), F.col("source_file").alias("file_name"), F.lit("transformed").alias("status"),
                F.current_timestamp().alias("event_time"), F.lit(batch_id).alias("seq"), "rows")
            # the control log's columns, so that the events can be appended to it, and the rows written
            ev = ev.select(*[(F.col(f.name) if f.name in ev.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                             for f in CONTROL_EVENT_SCHEMA.fields], "rows")
            ev.write.mode("overwrite").parquet(f"{events_path.rstrip('/')}/batch={batch_id}")
        return good.count()
    finally:
        batch.unpersist()


def ingest(spark: SparkSession, folder: str, entity: str, out_path: str, checkpoint: str,
           events_path: str | None = None, year_month: str | None = None) -> int:
    """Process new files of ``folder`` once (availableNow); returns rows written.

    ``checkpoint`` must be on the shared file system (e.g. below
    ``spark.checkpoint.dir``): it is what makes re-runs skip finished files
    and lets a restarted run resume after executor or driver loss.  Outputs
    are read back with ``spark.read.parquet(out_path)`` (``batch`` appears as
    a partition column).
    """
    silver = normalize(raw_stream(spark, folder, entity), entity)
    if year_month is not None:
        silver = silver.withColumn("year_month", F.lit(year_month))
    written = [0]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        written[0] += write_micro_batch(batch, batch_id, out_path, events_path, year_month)

    q = (silver.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return written[0]
