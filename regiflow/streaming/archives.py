"""Incremental ingest of archives with Structured Streaming (INC1, SRC2).

A streaming data source whose offset is the folder's listing: every archive with its size
and time of change.  A micro-batch has one input partition per archive that is new or has
changed since the last offset; its first member goes out as raw lines, which are parsed and
cleaned like those of a batch read.  ``ingest_archives`` writes them partitioned by archive
with dynamic overwrite: a rerun without changes has no batch, a repeated batch replaces its
own rows, and a changed archive replaces the rows of its former self.

The listing and the archives are read with Arrow's file systems (local or mounted paths,
``s3://``, ``gs://``, ``hdfs://``), since a streaming source has no Spark session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from regiflow.operators.rules import normalize
from regiflow.schema import LAYOUTS
from regiflow.sinks.publish import _target
from regiflow.sources.archives import BLOCK_BYTES, LINES, _Lines, _lines_batch, parsed
from regiflow.sources.csv import split_quarantine


class Archive(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder, self.multi_line = options["path"], options.get("multiLine", "false").lower() == "true"

    def _listing(self) -> dict:
        from pyarrow import fs
        store, root = _target(self.folder)
        found = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        return {i.path: f"{i.size}:{i.mtime_ns}" for i in sorted(found, key=lambda i: i.path) if i.is_file and i.path.lower().endswith(".zip")}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return self._listing()

    def partitions(self, start: dict, end: dict) -> list:
        return [Archive(p) for p, version in end.items() if start.get(p) != version]

    def read(self, partition: Archive):
        store, _ = _target(self.folder)
        lines, held, size = _Lines(partition.path, self.multi_line), [], 0
        with store.open_input_stream(partition.path) as stream:
            while block := stream.read(BLOCK_BYTES):
                for row, n in lines.feed(block):
                    held.append(row)
                    size += n + 64
                    if size >= 4 * BLOCK_BYTES:
                        yield _lines_batch(held)
                        held, size = [], 0
        held.extend(row for row, _ in lines.close())
        if held:
            yield _lines_batch(held)

    def commit(self, end: dict) -> None:
        pass                                   # the stream's checkpoint keeps the offset; nothing is held for it


class ArchiveStream(DataSource):
    @classmethod
    def name(cls):
        return "registry_archives"

    def schema(self):
        return LINES

    def streamReader(self, schema):
        return _Reader(self.options)


def archive_stream(spark: SparkSession, folder: str, multi_line: bool = False) -> DataFrame:
    """Streaming (source_file, member, line, error) of the folder's archives."""
    spark.dataSource.register(ArchiveStream)
    return spark.readStream.format("registry_archives").option("multiLine", str(multi_line).lower()).load(folder)


def ingest_archives(spark: SparkSession, folder: str, entity: str, out_path: str, checkpoint: str, year_month: str) -> int:
    """Take up new and changed archives of ``folder`` once; returns the number of micro-batches with archives.

    Rows go to ``out_path`` and damaged records to ``out_path`` + ``_quarantine``, partitioned
    by (year_month, source_file).  An archive that has become unreadable leaves its former
    rows in place and a quarantined reason.
    """
    if entity not in LAYOUTS:
        raise ValueError(f"unknown entity {entity!r}")
    batches = [0]

    def write(batch: DataFrame, batch_id: int) -> None:
        records = parsed(batch, entity).drop("member").persist()          # archives are inflated and parsed once for both tables
        good, bad = split_quarantine(records)
        try:
            for df, path in ((normalize(good, entity), out_path), (bad, f"{out_path}_quarantine")):
                (df.withColumn("year_month", F.lit(year_month)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("year_month", "source_file").parquet(path))
        finally:
            records.unpersist()
        batches[0] += 1

    q = (archive_stream(spark, folder).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return batches[0]
