"""Silver/gold writers and warehouse load modes (SNK1-SNK12).

* Silver: Parquet (snappy), partitioned by ``year_month`` so month filters
  prune partitions; the schema is declared, not inferred from a first chunk.
* Load modes per table, decided once at the start of a run for the union of
  all part files of the table: ``append`` (default), ``replace`` (one
  overwrite of the whole table, so no part replaces another) and ``skip``
  (table already holds rows).
* Every write goes through Spark's commit protocol: output of failed tasks is
  discarded and a failed job leaves no ``_SUCCESS`` marker, so no partial
  output is published.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiflow.functions.text import last_component, month_of_key, parquet_name

MODES = ("append", "replace", "skip")


def write_silver(df: DataFrame, path: str, partition_by: tuple[str, ...] = ("year_month",),
                 mode: str = "append", sort_within: str | None = "cnpj_basico") -> None:
    """Parquet with snappy; rows clustered by key inside each partition file.

    Sorting within partitions (no global sort, no extra shuffle) gives tight
    min/max statistics per row group, so key lookups skip most row groups.
    """
    out = df
    if sort_within and sort_within in df.columns:
        cols = [c for c in partition_by if c in df.columns]
        out = out.sortWithinPartitions(*cols, sort_within)
    w = out.write.mode(mode).option("compression", "snappy")
    parts = [c for c in partition_by if c in df.columns]
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(path)


def table_has_rows(spark: SparkSession, path: str) -> bool:
    """True when a Parquet table exists at ``path`` and holds at least one row."""
    try:
        return not spark.read.parquet(path).isEmpty()
    except Exception as e:  # a missing path is the only expected failure
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return False
        raise


def load_table(spark: SparkSession, df: DataFrame, path: str, mode: str = "append",
               partition_by: tuple[str, ...] = (), idempotent: bool = False) -> dict:
    """Load one table (all its part files already unioned in ``df``).

    With ``idempotent=True`` an append replaces exactly the partitions present
    in ``df`` (dynamic partition overwrite on ``partition_by``), so loading
    the same source files again after a failure cannot duplicate rows.
    Returns the outcome ``{"table": path, "mode": mode, "action": ...}``.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if idempotent and not partition_by:
        raise ValueError("idempotent loads need partition columns")
    if mode == "skip" and table_has_rows(spark, path):
        return {"table": path, "mode": mode, "action": "skipped"}
    write_mode = "overwrite" if (mode == "replace" or idempotent) else "append"
    w = df.write.mode(write_mode).option("compression", "snappy")
    # replace drops every old partition, whatever the session says; idempotent only those it brings
    w = w.option("partitionOverwriteMode", "dynamic" if idempotent and mode != "replace" else "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return {"table": path, "mode": mode, "action": "replaced" if mode == "replace" else "appended"}


def outcomes_frame(spark: SparkSession, outcomes: list[dict]) -> DataFrame:
    """Per-table outcome rows of a load run."""
    schema = T.StructType([T.StructField(k, T.StringType()) for k in ("table", "mode", "action")])
    return spark.createDataFrame([(o["table"], o["mode"], o["action"]) for o in outcomes], schema)


def create_table_if_missing(spark: SparkSession, name: str, schema: T.StructType, location: str | None = None,
                            partition_by: tuple[str, ...] = ()) -> None:
    """``CREATE TABLE IF NOT EXISTS`` from a StructType (Parquet)."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{part}{loc}")


def unprocessed_inputs(inputs: DataFrame, processed: DataFrame, name_col: str = "file_name") -> DataFrame:
    """Raw inputs (year_month, file name) whose processed Parquet of that month does not exist yet."""
    done = processed.select(month_of_key(F.col("key")).alias("__month"), last_component(F.col("key")).alias("__done"))
    return inputs.join(done, (F.col("year_month") == F.col("__month")) & (parquet_name(F.col(name_col)) == F.col("__done")), "left_anti")
