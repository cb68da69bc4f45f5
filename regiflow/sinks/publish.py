"""Publishing files: a resumable copy to another store, checked by size and hash (SNK11).

The files' bytes are read as streams by Spark (``byte_stream``), so from any store, and
written by a data source writer: each task writes its files under a name of the attempt,
checks the number of bytes, and moves them to their place; what it has written goes back
as commit messages, which the driver turns into one record per file.  A failed job's
``abort`` removes what its tasks have left.  Targets are opened with Arrow's file systems
(local or mounted paths, ``s3://``, ``gs://``, ``hdfs://``).

``publish`` copies what the records and the target's own sizes do not show as there
already, so a second run copies nothing, and an object that is half there or was replaced
is copied again.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from regiflow.sources.byte_stream import BOM, SEPARATOR, byte_rows
from regiflow.sources.listing import inventory

RECORD = "key string, size_bytes long, content_hash string"
RECORDS = "_published"


def _target(root: str):
    """(Arrow file system, path) of a folder or file."""
    from pyarrow import fs
    if "://" in root and not root.startswith("file:"):
        return fs.FileSystem.from_uri(root)
    return fs.LocalFileSystem(), root.removeprefix("file:").replace("//", "/") if root.startswith("file:") else root


@dataclass
class Copied(WriterCommitMessage):
    files: list


class _Writer(DataSourceWriter):
    def __init__(self, options: dict):
        self.root, self.attempt = options["path"], uuid.uuid4().hex

    def write(self, iterator) -> Copied:
        store, root = _target(self.root)
        done, state = [], {}

        def close():
            key, size, out, part, digest, n = state["all"]
            gap = size - n
            if gap in (len(SEPARATOR), len(SEPARATOR) + len(BOM)):
                out.write(SEPARATOR.encode())                # the reader leaves out a last separator
                digest.update(SEPARATOR.encode())
                gap -= len(SEPARATOR)
            out.close()
            if gap:
                store.delete_file(part)
                raise OSError(f"{key}: {gap} of {size} bytes are missing")
            store.move(part, f"{root}/{key}")
            done.append((key, size, digest.hexdigest()))

        for row in iterator:
            if "all" in state and state["all"][0] != row["key"]:
                close()
                del state["all"]
            if "all" not in state:
                folder = f"{root}/{row['key']}".rpartition("/")[0]
                store.create_dir(folder, recursive=True)
                part = f"{root}/{row['key']}.{self.attempt}.{uuid.uuid4().hex}.part"
                state["all"] = [row["key"], row["size"], store.open_output_stream(part), part, hashlib.sha256(), 0]
                first = b""
            else:
                first = SEPARATOR.encode()
            data = first + bytes(row["bytes"])
            state["all"][2].write(data)
            state["all"][4].update(data)
            state["all"][5] += len(data)
        if "all" in state:
            close()
        return Copied(done)

    def _record(self, messages):
        store, root = _target(self.root)
        files = [f for m in messages if m is not None for f in m.files]
        if files:
            store.create_dir(f"{root}/{RECORDS}", recursive=True)
            with store.open_output_stream(f"{root}/{RECORDS}/{self.attempt}.json") as out:
                out.write("\n".join(json.dumps({"key": k, "size_bytes": n, "content_hash": h}) for k, n, h in files).encode())

    def commit(self, messages) -> None:
        self._record(messages)

    def abort(self, messages) -> None:
        from pyarrow import fs
        self._record(messages)                               # what was moved to its place is there, and need not be copied again
        store, root = _target(self.root)
        for info in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            if f".{self.attempt}." in info.path and info.path.endswith(".part"):
                store.delete_file(info.path)


class CopyDataSource(DataSource):
    @classmethod
    def name(cls):
        return "registry_copy"

    def schema(self):
        return "key string, size long, bytes binary"

    def writer(self, schema, overwrite):
        return _Writer(self.options)


def records(spark: SparkSession, target: str) -> DataFrame:
    """(key, size_bytes, content_hash) of what was published to the target, the latest record of each key."""
    try:
        log = spark.read.schema(RECORD).json(f"{target}/{RECORDS}")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], RECORD)
    return (log.withColumn("_t", F.col("_metadata.file_modification_time")).groupBy("key")
            .agg(F.max_by(F.struct("size_bytes", "content_hash"), "_t").alias("r")).select("key", "r.*"))


def pending(spark: SparkSession, source: str, target: str, glob: str | None = None) -> DataFrame:
    """(key, path, size_bytes) of the source's files that the target does not hold with the recorded size."""
    files = inventory(spark, source, glob).select("key", "path", "size_bytes")
    try:
        there = inventory(spark, target).select("key", F.col("size_bytes").alias("there"))
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return files
    same = records(spark, target).select("key", F.col("size_bytes").alias("recorded")).join(there, "key").where("recorded = there")
    return files.join(same.select("key", F.col("there").alias("size_bytes")), ["key", "size_bytes"], "left_anti").select("key", "path", "size_bytes")


def publish(spark: SparkSession, source: str, target: str, glob: str | None = None) -> DataFrame:
    """Copy what is pending; returns (key, size_bytes, content_hash) of what this call has copied."""
    spark.dataSource.register(CopyDataSource)
    todo = pending(spark, source, target, glob).collect()        # names of the files to copy
    if not todo:
        return spark.createDataFrame([], RECORD)
    keys = spark.createDataFrame([(r["key"], r["path"]) for r in todo], "key string, path string")
    rows = byte_rows(spark, [r["path"] for r in todo])
    order = ["key", "at", "pos"]
    named = rows.join(F.broadcast(keys), "path").repartition(2 * len(todo), "key").sortWithinPartitions(*order)
    named.select("key", "size", "bytes").write.format("registry_copy").mode("append").save(target)
    return records(spark, target).join(F.broadcast(keys.select("key")), "key", "left_semi")
