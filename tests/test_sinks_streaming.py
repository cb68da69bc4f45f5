"""Load modes, idempotent re-runs and the incremental streaming ingest."""

import os

from pyspark.sql import functions as F

from regiflow.sinks.tables import create_table_if_missing, load_table, unprocessed_inputs, write_silver
from regiflow.plans import silver
from regiflow.schema import typed_schema
from regiflow.streaming.incremental import ingest
from tests.conftest import SF_SMALL
from tests.fixtures import DIRTY_LINES, csv_lines, write_csv


def test_load_modes(spark, tmp_path):
    companies = silver.companies(spark, SF_SMALL)
    n = companies.count()
    parts = [companies.where(F.col("natureza_juridica") == str(2000 + i)) for i in range(25)]
    from functools import reduce
    union = reduce(lambda a, b: a.unionByName(b), parts)
    path = str(tmp_path / "cnpj_empresas")
    assert load_table(spark, union, path, "skip")["action"] == "appended"      # empty table: skip loads
    assert load_table(spark, union, path, "append")["action"] == "appended"
    assert spark.read.parquet(path).count() == 2 * n
    assert load_table(spark, union, path, "replace")["action"] == "replaced"    # one overwrite for all parts
    assert spark.read.parquet(path).count() == n
    assert load_table(spark, union, path, "skip")["action"] == "skipped"
    assert spark.read.parquet(path).count() == n


def test_write_silver_partitioned(spark, tmp_path):
    df = silver.companies(spark, SF_SMALL).withColumn("year_month", F.lit("2025-06"))
    out = str(tmp_path / "silver")
    write_silver(df, out)
    assert os.path.isdir(os.path.join(out, "year_month=2025-06"))
    back = spark.read.parquet(out).where(F.col("year_month") == "2025-06")
    assert back.count() == df.count()


def test_unprocessed_inputs(spark):
    names = ["Empresas0.zip", "Empresas1.zip", "Socios0.zip"]
    inputs = spark.createDataFrame([(m, n) for m in ("2025-05", "2025-06") for n in names], "year_month string, file_name string")
    processed = spark.createDataFrame([("processed/2025-06/Empresas1.parquet",)], "key string")
    got = sorted(tuple(r) for r in unprocessed_inputs(inputs, processed).collect())
    assert got == [("2025-05", n) for n in names] + [("2025-06", "Empresas0.zip"), ("2025-06", "Socios0.zip")]


def test_replace_drops_old_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    may = spark.createDataFrame([("1", "2025-05"), ("2", "2025-06")], "cnpj_basico string, year_month string")
    june = spark.createDataFrame([("3", "2025-06")], may.schema)
    load_table(spark, may, path, "append", partition_by=("year_month",))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")     # whatever the session says
    try:
        load_table(spark, june, path, "append", partition_by=("year_month",), idempotent=True)
        assert {tuple(r) for r in spark.read.parquet(path).select("cnpj_basico", "year_month").collect()} == {("1", "2025-05"), ("3", "2025-06")}
        load_table(spark, june, path, "replace", partition_by=("year_month",))
        assert [tuple(r) for r in spark.read.parquet(path).select("cnpj_basico").collect()] == [("3",)]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_names_repeat_every_month(spark):
    """Joins of control and processed files go by month and name."""
    from regiflow.operators import integrity as I
    from regiflow.sources.resolve import resolve_sources
    months = ["2025-05", "2025-06"]
    control = spark.createDataFrame([(m, "Empresas0.zip", "loaded", 10) for m in months],
                                    "year_month string, file_name string, status string, local_size_bytes long")
    stats = spark.createDataFrame([("2025-05", "Empresas0.parquet", 7, 70), ("2025-06", "Empresas0.parquet", 8, 80)],
                                  "year_month string, parquet_file string, row_count long, size_bytes long")
    got = {r.year_month: r.row_count for r in I.transform_status(control, stats).collect()}
    assert got == {"2025-05": 7, "2025-06": 8}
    status = I.load_status(control, stats, I.table_counts(control, stats)).collect()
    assert {(r.year_month, r.parquet_rows, r.db_rows) for r in status} == {("2025-05", 7, 15), ("2025-06", 8, 15)} and len(status) == 2
    local = spark.createDataFrame([(m, "Empresas0.zip", f"local:{m}", 1) for m in months], "year_month string, file_name string, location string, size_bytes long")
    assert {r.location for r in resolve_sources(local, local.limit(0)).collect()} == {"local:2025-05", "local:2025-06"}


def test_create_table_if_missing(spark, tmp_path):
    create_table_if_missing(spark, "t_simples", typed_schema("Simples"), str(tmp_path / "t"))
    create_table_if_missing(spark, "t_simples", typed_schema("Simples"), str(tmp_path / "t"))
    assert spark.table("t_simples").columns[0] == "cnpj_basico"
    spark.sql("DROP TABLE t_simples")


def test_incremental_ingest_reruns_add_nothing(spark, tmp_path):
    lines = csv_lines(spark, SF_SMALL)
    raw = tmp_path / "raw"
    write_csv(str(raw / "Empresas0.csv"), lines[:70])
    write_csv(str(raw / "Empresas1.csv"), lines[70:] + DIRTY_LINES)
    out, ckpt, ev = str(tmp_path / "silver"), str(tmp_path / "ckpt"), str(tmp_path / "events")
    first = ingest(spark, str(raw), "Empresas", out, ckpt, events_path=ev, year_month="2025-06")
    assert first == len(lines) + len(DIRTY_LINES) - 2
    assert spark.read.parquet(out).count() == first
    assert spark.read.parquet(out + "_quarantine").count() == 2
    assert ingest(spark, str(raw), "Empresas", out, ckpt, events_path=ev, year_month="2025-06") == 0
    write_csv(str(raw / "Empresas2.csv"), lines[:5])
    assert ingest(spark, str(raw), "Empresas", out, ckpt, events_path=ev, year_month="2025-06") == 5
    events = spark.read.parquet(ev)
    assert sorted(r["file_name"] for r in events.collect()) == ["Empresas0.csv", "Empresas1.csv", "Empresas2.csv"]


def test_micro_batch_rerun_is_idempotent(spark, tmp_path):
    from regiflow.operators.rules import normalize
    from regiflow.sources.csv import read_entity
    from regiflow.streaming.incremental import write_micro_batch
    lines = csv_lines(spark, SF_SMALL)
    write_csv(str(tmp_path / "raw" / "Empresas0.csv"), lines[:40] + DIRTY_LINES)
    batch = normalize(read_entity(spark, str(tmp_path / "raw"), "Empresas"), "Empresas")
    out, ev = str(tmp_path / "silver"), str(tmp_path / "events")
    n1 = write_micro_batch(batch, 7, out, ev, "2025-06")
    n2 = write_micro_batch(batch, 7, out, ev, "2025-06")   # the same batch re-executed
    assert n1 == n2 == 40 + len(DIRTY_LINES) - 2
    assert spark.read.parquet(out).count() == n1
    assert spark.read.parquet(ev).count() == 1
