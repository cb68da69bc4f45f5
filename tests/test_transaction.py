"""Runs that publish several tables at once, and counts from footers."""

import pytest
from pyspark.sql import functions as F

from regiflow.plans.monthly import current_state, run_month
from regiflow.sinks import transaction as TX
from regiflow.sources.footers import footer_counts, footer_statistics
from tests.conftest import SF_SMALL
from tests.fixtures import csv_lines, write_zip


def numbers(spark, n, part="a"):
    return spark.range(n).select("id", F.lit(part).alias("part"))


def seen(spark, root, *tables):
    got = [TX.read_table(spark, root, t) for t in tables]
    return [None if g is None else g.count() for g in got]


def test_a_run_is_seen_whole_or_not_at_all(spark, tmp_path):
    root = str(tmp_path / "w")
    first = TX.Run(spark, root)
    first.stage("x", numbers(spark, 10), partition_by=("part",))
    assert seen(spark, root, "x", "y") == [None, None]
    first.stage("y", numbers(spark, 5))
    first.publish()
    assert seen(spark, root, "x", "y") == [10, 5]
    stopped = TX.Run(spark, root)                               # stops between two tables
    stopped.stage("x", numbers(spark, 99), partition_by=("part",))
    assert seen(spark, root, "x", "y") == [10, 5]
    again = TX.Run(spark, root)                                 # the same partition, replaced; another one added
    again.stage("x", numbers(spark, 7).union(numbers(spark, 3, "b")), partition_by=("part",))
    again.stage("y", numbers(spark, 2))
    assert seen(spark, root, "x", "y") == [10, 5]
    version = again.publish()
    assert version == 2 and seen(spark, root, "x", "y") == [10, 7]
    assert TX.read_table(spark, root, "x", version=1).count() == 10          # an older state, while it is kept
    assert TX.sweep(spark, root) == []                                       # the stopped run may still be at work
    gone = TX.sweep(spark, root, keep=1, open_hours=0)
    assert f"x/run={stopped.id}" in gone and seen(spark, root, "x", "y") == [10, 7]


def test_two_runs_at_once_and_modes(spark, tmp_path):
    root = str(tmp_path / "w")
    a, b = TX.Run(spark, root), TX.Run(spark, root)
    a.stage("x", numbers(spark, 4, "a"), partition_by=("part",))
    b.stage("x", numbers(spark, 6, "b"), partition_by=("part",))
    assert (a.publish(), b.publish()) == (1, 2)
    assert seen(spark, root, "x") == [10]
    c = TX.Run(spark, root)
    assert c.stage("x", numbers(spark, 1), "skip")["action"] == "skipped"
    c.stage("z", numbers(spark, 1), "skip")
    c.publish()
    assert seen(spark, root, "x", "z") == [10, 1]
    small = TX.Run(spark, root)                                 # compaction keeps what came since it read
    small.stage("x", TX.read_table(spark, root, "x").where("id = 0"), "compact", ("part",))
    late = TX.Run(spark, root)
    late.stage("x", numbers(spark, 3, "c"), partition_by=("part",))
    late.publish()
    small.publish()
    assert seen(spark, root, "x") == [2 + 3]
    d = TX.Run(spark, root)
    d.stage("x", numbers(spark, 2, "q"), "replace", ("part",))
    d.publish()
    assert [r.part for r in TX.read_table(spark, root, "x").select("part").distinct().collect()] == ["q"]
    e = TX.Run(spark, root)
    e.stage("x", numbers(spark, 2, "q"), "replace", ("part",))
    e.abort()
    assert seen(spark, root, "x") == [2]
    with pytest.raises(ValueError):
        TX.Run(spark, root).stage("x", numbers(spark, 1), "other")


def test_monthly_run_in_one_transaction(spark, tmp_path, monkeypatch):
    raw, work = str(tmp_path / "raw"), str(tmp_path / "work")
    comp = csv_lines(spark, SF_SMALL)
    write_zip(f"{raw}/2025-06/Empresas0.zip", {"a.csv": comp[:60]})
    write_zip(f"{raw}/2025-06/Simples.zip", {"s.csv": ["1;S;20070101;0;N;;00000000"]})
    real = TX.Run.publish
    monkeypatch.setattr(TX.Run, "publish", lambda self: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        run_month(spark, raw, work, "2025-06", atomic=True)
    assert seen(spark, work, "warehouse/empresas", "warehouse/simples") == [None, None]
    monkeypatch.setattr(TX.Run, "publish", real)
    out = {r["file_name"]: r["outcome"] for r in run_month(spark, raw, work, "2025-06", atomic=True).collect()}
    assert out == {"Empresas0.zip": "loaded", "Simples.zip": "loaded"}
    assert seen(spark, work, "warehouse/empresas", "warehouse/simples") == [60, 1]
    assert {r["status"] for r in current_state(spark, f"{work}/control_log").collect()} == {"loaded"}
    write_zip(f"{raw}/2025-06/Empresas1.zip", {"a.csv": comp[60:80]})
    run_month(spark, raw, work, "2025-06", atomic=True)
    assert seen(spark, work, "warehouse/empresas", "processed/empresas") == [80, 80]


def test_counts_come_from_footers(spark, tmp_path):
    folder = str(tmp_path / "t")
    df = spark.range(1000).select("id", F.concat(F.lit("2025-0"), F.col("id") % 3 + 1).alias("year_month"),
                                  F.concat(F.lit("E "), F.col("id") % 7, F.lit(".zip")).alias("source_file"))
    df.repartition(4).write.partitionBy("year_month", "source_file").parquet(folder)
    want = {(r.year_month, r.source_file): r["count"] for r in df.groupBy("year_month", "source_file").count().collect()}
    counts = footer_counts(spark, folder)
    plan = counts._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [year_month, source_file]" in plan
    stats = footer_statistics(spark, folder)
    assert {(r.year_month, r.source_file): r.row_count for r in stats.collect()} == want
    assert stats.agg(F.sum("files")).first()[0] >= 21 and stats.where("size_bytes <= 0").count() == 0
    with pytest.raises(ValueError):
        footer_counts(spark, folder, ("month",))


def test_processed_files_are_written_in_pieces(spark, monkeypatch):
    from regiflow.plans import q_warehouse
    from regiflow.plans import records as R
    from regiflow.sources.footers import footer_statistics
    made, own = [], R.shared_folder
    monkeypatch.setattr(R, "shared_folder", lambda s, name: made.append(own(s, name)) or made[-1])
    monkeypatch.setattr(q_warehouse, "FILE_ROWS", 20, raising=False)
    rows = {(r.year_month, r.source_file): r.row_count for r in q_warehouse.footer_row_counts(spark, SF_SMALL).collect()}
    files = {(r.year_month, r.source_file): r.files for r in footer_statistics(spark, made[0]).collect()}
    assert sum(rows.values()) == R.records(spark, SF_SMALL, "Socios").count() and rows.keys() == files.keys()
    assert max(files.values()) > 5
