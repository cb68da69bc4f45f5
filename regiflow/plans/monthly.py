"""One month of registry ingest (ORC1): discover -> register -> transform -> load.

Every step is a Spark job over DataFrames; the driver only sequences them and
handles the month's archive list (file metadata, tens of rows), never rows of
data.  State changes are appended to the control event log, so a failed or
repeated run is safe: files already transformed are skipped, and the latest
state per file is always ``latest_state(log)``.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiflow.functions.text import file_type, table_name, parquet_name
from regiflow.operators.casting import rejects, to_typed
from regiflow.operators.control import latest_state
from regiflow.operators.rules import normalize
from regiflow.schema import CONTROL_EVENT_SCHEMA, LAYOUTS, TYPED
from regiflow.sinks.tables import load_table
from regiflow.sinks.transaction import Run
from regiflow.sources.archives import read_zip
from regiflow.sources.csv import CORRUPT, split_quarantine
from regiflow.sources.listing import inventory

EVENT_COLUMNS = [f.name for f in CONTROL_EVENT_SCHEMA.fields]


def _events(df: DataFrame, status: str, seq: int, error: F.Column | None = None) -> DataFrame:
    """Control events for the files of ``df`` (year_month, file_name, size)."""
    cols = {f.name: F.lit(None).cast(f.dataType) for f in CONTROL_EVENT_SCHEMA.fields}
    cols.update({
        "year_month": F.col("year_month"), "file_name": F.col("file_name"),
        "file_size_bytes": F.col("size_bytes"), "local_size_bytes": F.col("size_bytes"),
        "status": F.lit(status), "event_time": F.current_timestamp(), "seq": F.lit(seq).cast("long"),
        "download_progress": F.lit(100.0), "error_message": error if error is not None else F.lit(None).cast("string"),
    })
    return df.select(*[cols[c].cast(CONTROL_EVENT_SCHEMA[c].dataType).alias(c) for c in EVENT_COLUMNS])


def current_state(spark: SparkSession, log_path: str) -> DataFrame:
    """Latest state per file from the event log (empty when no log exists yet)."""
    try:
        return latest_state(spark.read.schema(CONTROL_EVENT_SCHEMA).parquet(log_path))
    except Exception as e:  # a missing log means nothing is known yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
    return spark.createDataFrame([], CONTROL_EVENT_SCHEMA)


def run_month(spark: SparkSession, raw_root: str, work_root: str, year_month: str,
              load_mode: str = "append", first_only: bool = False, log: str | None = None, atomic: bool = False,
              only: list[str] | None = None, force: bool = False) -> DataFrame:
    """Ingest the archives of ``raw_root/year_month``; returns one outcome row per file.

    Silver and warehouse tables are partitioned by ``(year_month,
    source_file)`` and written with dynamic partition overwrite, so a file
    processed again (e.g. after a crash between the data write and its state
    event) replaces its own rows instead of duplicating them.

    ``only`` takes the named files alone; ``force`` also those that were taken up before, whose
    rows are replaced.  With ``atomic`` all tables of the run are staged and published together
    (``sinks.transaction``): readers of ``transaction.read_table(spark, work_root, name)`` see
    the whole run or nothing of it.
    """
    run = Run(spark, work_root) if atomic else None
    by_file = ("year_month", "source_file")

    def put(df: DataFrame, name: str, mode: str = "append") -> dict:
        if run is not None:
            return run.stage(name, df, mode, by_file)
        return load_table(spark, df, f"{work_root}/{name}", mode, partition_by=by_file, idempotent=True)

    told_later: list[DataFrame] = []

    def tell(events: list[DataFrame]) -> None:
        while events:
            events.pop(0).write.mode("append").partitionBy("year_month").parquet(log)
    log = log or f"{work_root}/control_log"
    files = (inventory(spark, f"{raw_root}/{year_month}", glob="*.[zZ][iI][pP]")
             .select(F.lit(year_month).alias("year_month"), F.element_at(F.split("key", "/"), -1).alias("file_name"),
                     "path", "size_bytes")
             .withColumn("file_type", file_type(F.col("file_name"))))
    state = current_state(spark, log)

    # 1. register files not yet known (file grain inside the month)
    new = files.join(state.select("year_month", "file_name"), ["year_month", "file_name"], "left_anti")
    _events(new, "pending", 0).write.mode("append").partitionBy("year_month").parquet(log)

    # 2. plan: files not transformed yet, first per type when asked
    done = state.where(F.col("status").isin("transformed", "loaded")).select("year_month", "file_name")
    todo = files if force else files.join(done, ["year_month", "file_name"], "left_anti")
    if only is not None:
        todo = todo.where(F.col("file_name").isin(only))
    if first_only:
        firsts = todo.groupBy("file_type").agg(F.min("file_name").alias("file_name"))
        todo = todo.join(firsts, ["file_type", "file_name"], "left_semi")
    plan = todo.select("file_type", "file_name", "path").collect()  # archive list of one month

    outcomes: list[DataFrame] = []
    unmapped = todo.where(~F.col("file_type").isin(list(LAYOUTS)))
    told = state.where(F.col("error_message") == "not_mapped").select("year_month", "file_name")
    _events(unmapped.join(told, ["year_month", "file_name"], "left_anti"), "downloaded", 1, F.lit("not_mapped")).write.mode("append").partitionBy("year_month").parquet(log)
    outcomes.append(unmapped.select("file_name", "file_type", F.lit(None).cast("long").alias("rows"),
                                    F.lit("skipped").alias("outcome"), F.lit("not_mapped").alias("reason")))

    # 3. transform + 4. load, one read per entity over all its parts
    by_entity: dict[str, list[str]] = {}
    for r in plan:
        if r["file_type"] in LAYOUTS:
            by_entity.setdefault(r["file_type"], []).append(r["path"])
    for entity, paths in sorted(by_entity.items()):
        # archives are decompressed once: the spread text feeds all writes
        raw = read_zip(spark, sorted(paths), entity, cores=spark.sparkContext.defaultParallelism).persist(StorageLevel.MEMORY_AND_DISK)
        broken = raw.where((F.col("member") == "") & F.col(CORRUPT).isNotNull()).groupBy("source_file").agg(F.min(CORRUPT).alias("why"))
        failed = {r["source_file"]: r["why"] for r in broken.collect()}            # at most the month's archives
        readable = raw.where(~F.col("source_file").isin(list(failed))).drop("member") if failed else raw.drop("member")
        good, bad = split_quarantine(readable)
        silver = normalize(good, entity).withColumn("year_month", F.lit(year_month))
        table = f"processed/{entity.lower()}"
        put(silver, table)
        put(bad.withColumn("year_month", F.lit(year_month)), f"quarantine/{entity.lower()}")
        raw.unpersist()
        names = [os.path.basename(p) for p in paths if os.path.basename(p) not in failed]
        written = run.read_staged(table) if run is not None else spark.read.schema(silver.schema).parquet(f"{work_root}/{table}")
        written = (written
                   .where((F.col("year_month") == year_month) & F.col("source_file").isin(names)))
        counts = written.groupBy(F.col("source_file").alias("file_name")).agg(F.count(F.lit(1)).alias("rows"))
        why = F.create_map(*[F.lit(x) for kv in failed.items() for x in kv]) if failed else F.create_map(F.lit(""), F.lit(""))
        part_files = files.where(F.col("file_type") == entity).join(
            spark.createDataFrame([(os.path.basename(p),) for p in paths], "file_name string"), "file_name")
        # only files with written rows advance; the others are errors and planned again by the next run
        part_files = part_files.join(counts, "file_name", "left").withColumn(
            "why", F.when(F.col("rows").isNull(), F.coalesce(F.try_element_at(why, F.col("file_name")), F.lit("no rows written"))))
        done_files, errors = part_files.where("why is null"), part_files.where("why is not null")
        _events(errors, "error", 2, F.col("why")).write.mode("append").partitionBy("year_month").parquet(log)
        told_later.append(_events(done_files, "transformed", 2))
        typed = to_typed(written, entity) if entity in TYPED else written
        result = put(typed, f"warehouse/{entity.lower()}", load_mode)
        if entity in TYPED and result["action"] != "skipped":
            put(rejects(written, entity, keep=by_file), f"rejects/{entity.lower()}")
        status = "loaded" if result["action"] != "skipped" else "transformed"
        if status == "loaded":
            told_later.append(_events(done_files, "loaded", 3))
        if run is None:
            tell(told_later)
        outcomes.append(part_files.select("file_name", "file_type", F.col("rows").cast("long"),
                                          F.when(F.col("why").isNull(), status).otherwise("error").alias("outcome"),
                                          F.coalesce("why", F.lit(result["action"])).alias("reason")))
    if run is not None:
        run.publish()
        tell(told_later)          # after the rows can be seen; without these events the files are taken up again, and replaced
    return reduce(lambda a, b: a.unionByName(b), outcomes)


def run_counters(outcomes: DataFrame) -> DataFrame:
    """One row for a run: files processed, skipped and in error, and rows written."""
    is_ = lambda *x: F.count_if(F.col("outcome").isin(*x))
    return outcomes.agg(is_("transformed", "loaded").alias("processed"), is_("skipped").alias("skipped"), is_("error").alias("errors"),
                        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"))


def table_of(file_name_col: F.Column) -> F.Column:
    """Warehouse table of a raw archive name."""
    return table_name(parquet_name(file_name_col))

