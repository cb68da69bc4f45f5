"""Small files and folders through Hadoop's file system interface, on the driver (metadata only)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it is not there."""
    fs, p = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def modified(spark: SparkSession, path: str) -> float:
    """Seconds since the epoch of a file's last change."""
    fs, p = _at(spark, path)
    return fs.getFileStatus(p).getModificationTime() / 1000


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _at(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def rename(spark: SparkSession, old: str, new: str) -> bool:
    """False if the new name is taken."""
    fs, p = _at(spark, old)
    to = _at(spark, new)[1]
    return not fs.exists(to) and bool(fs.rename(p, to))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)
