"""Bytes of files of any size on any file system that Spark reads, in order.

Spark's text source with a two-byte record separator yields a file's bytes in rows that
one executor task after the other can read: splits are read in parallel, the separator
is known and so is the file's size, hence nothing is lost.  Rows are then brought
together by file and sorted by their place, and a task works through them as a stream;
it never holds more than a batch of rows.  No path is opened by Python, so ``s3a://``,
``hdfs://`` or ``viewfs://`` inputs and local ones are read alike.

``PK`` is the separator: the signature of every part of a ZIP archive begins with it,
and in compressed data it comes up every 64 KB or so.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEPARATOR = "PK"
BOM = b"\xef\xbb\xbf"          # dropped by the reader at the beginning of a file


def byte_rows(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """(path, size, at, pos, bytes): rows of the files' bytes between separators; files in order, each in one task.

    ``paths``: files, folders (with what is below them) or globs.  Files without bytes have no row.
    """
    reader = spark.read.option("lineSep", SEPARATOR).option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.text(paths)
    files = max(1, len(df.inputFiles()))                 # names only, of the files that will be read
    rows = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
                     F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("pos"),
                     F.col("value").cast("binary").alias("bytes"))
    # a file is one stream, so it is one task's work; twice as many partitions as files keep most apart
    return rows.repartition(2 * files, "path").sortWithinPartitions("path", "at", "pos")


class _Whole:
    """Puts the separators back between the rows of one file."""

    def __init__(self, size: int):
        self.size, self.seen, self.rows = size, 0, 0
        self.late_bom: bytes = b""

    def __call__(self, row: bytes) -> Iterator[bytes]:
        if self.rows:
            self.seen += len(SEPARATOR)
            yield SEPARATOR.encode()
        self.rows += 1
        self.seen += len(row)
        yield row

    def rest(self) -> bytes:
        """What the reader leaves out at the end: a last separator."""
        return SEPARATOR.encode() if self.size - self.seen in (len(SEPARATOR), len(SEPARATOR) + len(BOM)) else b""

    def lost_bom(self) -> bool:
        return self.size - self.seen >= len(BOM)


def per_file(batches, start: Callable, to_batch: Callable[[list], pa.RecordBatch], most: int = 4 << 20):
    """Run ``start(path)`` (an object with ``feed(bytes)`` and ``close()``, both yielding (output row, bytes in it))
    over every file of a task's rows; rows go out in batches of about ``most`` bytes."""
    path, whole, reader, out, held = None, None, None, [], 0

    def ended():
        yield from reader.feed(whole.rest())
        yield from reader.close()

    def flow():
        nonlocal path, whole, reader
        for batch in batches:
            for p, size, row in zip(batch.column("path").to_pylist(), batch.column("size").to_pylist(), batch.column("bytes")):
                if p != path:
                    if reader is not None:
                        yield from ended()
                    path, whole, reader = p, _Whole(size), start(p)
                for part in whole(row.as_py()):
                    yield from reader.feed(part)
        if reader is not None:
            yield from ended()

    for row, n in flow():
        out.append(row)
        held += n + 64
        if held >= most:
            yield to_batch(out)
            out, held = [], 0
    if out:
        yield to_batch(out)


def name_of(path: str) -> str:
    """A file's name; a partition folder (``source_file=name``) that holds it names it instead."""
    from urllib.parse import unquote
    for part in reversed(path.split("/")[:-1]):
        if part.startswith("source_file="):
            return unquote(unquote(part[len("source_file="):]))
    return unquote(path.rsplit("/", 1)[-1])


def file_hashes(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """(path, content_hash): SHA-256 of whole files of any size, as streams.

    A stretch without the two separator bytes is one row and so is held in memory at once.
    """
    import hashlib

    class Hash:
        def __init__(self, path: str):
            self.path, self.plain, self.marked = path, hashlib.sha256(), hashlib.sha256(BOM)
            self.seen = 0

        def feed(self, data: bytes):
            self.plain.update(data)
            self.marked.update(data)
            self.seen += len(data)
            return iter(())

        def close(self):
            yield (self.path, self.plain.hexdigest(), self.marked.hexdigest(), self.seen), 0

    def to_batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
            (pa.string(), pa.string(), pa.string(), pa.int64()))], ["path", "plain", "marked", "seen"])

    rows = byte_rows(spark, paths, glob)
    sizes = rows.select("path", "size")
    hashed = rows.mapInArrow(lambda b: per_file(b, Hash, to_batch), "path string, plain string, marked string, seen long")
    sizes = sizes.groupBy("path").agg(F.max("size").alias("size"))
    return hashed.join(sizes, "path").select("path", F.when(F.col("size") == F.col("seen"), F.col("plain")).otherwise(
        F.col("marked")).alias("content_hash"))
