"""Monthly ingest end to end on archives generated from the driver tables."""

from pyspark.sql import functions as F

from regiflow.plans import standins as S
from regiflow.plans.monthly import current_state, run_month
from regiflow.schema import LAYOUTS
from tests.conftest import SF_SMALL
from tests.fixtures import DIRTY_LINES, csv_lines, write_zip


def _lines(df, entity):
    out = []
    for r in df.collect():
        out.append(";".join("" if r[c] is None else r[c] for c in LAYOUTS[entity] if c in df.columns))
    return out


def test_run_month(spark, tmp_path):
    raw, work = str(tmp_path / "raw"), str(tmp_path / "work")
    comp = csv_lines(spark, SF_SMALL)
    write_zip(f"{raw}/2025-06/Empresas0.zip", {"a.csv": comp[:60]})
    write_zip(f"{raw}/2025-06/Empresas1.zip", {"b.csv": comp[60:] + DIRTY_LINES})
    simples = S.raw_simples(spark, SF_SMALL)
    write_zip(f"{raw}/2025-06/Simples.zip", {"s.csv": _lines(simples, "Simples")})
    write_zip(f"{raw}/2025-06/Outros.zip", {"o.csv": ["x;y"]})
    out = {r["file_name"]: r for r in run_month(spark, raw, work, "2025-06").collect()}
    assert out["Outros.zip"]["outcome"] == "skipped" and out["Outros.zip"]["reason"] == "not_mapped"
    assert out["Empresas0.zip"]["rows"] == 60 and out["Empresas0.zip"]["outcome"] == "loaded"
    assert out["Empresas1.zip"]["rows"] == len(comp) - 60 + len(DIRTY_LINES) - 2
    assert out["Simples.zip"]["rows"] == simples.count()
    gold = spark.read.parquet(f"{work}/warehouse/empresas")
    assert gold.count() == len(comp) + len(DIRTY_LINES) - 2
    assert spark.read.parquet(f"{work}/quarantine/empresas").count() == 2
    state = {r["file_name"]: r["status"] for r in current_state(spark, f"{work}/control_log").collect()}
    assert state == {"Empresas0.zip": "loaded", "Empresas1.zip": "loaded", "Simples.zip": "loaded",
                     "Outros.zip": "downloaded"}
    # a second run finds nothing new to transform and loads nothing twice
    again = run_month(spark, raw, work, "2025-06")
    assert again.where(F.col("outcome") == "loaded").count() == 0
    assert spark.read.parquet(f"{work}/warehouse/empresas").count() == gold.count()


def test_run_month_reprocessing_does_not_duplicate(spark, tmp_path):
    raw, work = str(tmp_path / "raw"), str(tmp_path / "work")
    comp = csv_lines(spark, SF_SMALL)
    write_zip(f"{raw}/2025-06/Empresas0.zip", {"a.csv": comp[:70]})
    write_zip(f"{raw}/2025-06/Empresas1.zip", {"b.csv": comp[70:]})
    run_month(spark, raw, work, "2025-06")
    n = spark.read.parquet(f"{work}/warehouse/empresas").count()
    # state events lost (crash after the data writes): everything is processed again
    run_month(spark, raw, work, "2025-06", log=str(tmp_path / "fresh_log"))
    assert spark.read.parquet(f"{work}/warehouse/empresas").count() == n == len(comp)
    assert spark.read.parquet(f"{work}/processed/empresas").count() == n


def test_bad_archives_do_not_stop_the_month(spark, tmp_path):
    """Corrupt, empty and damaged archives become errors; the others are loaded, typed."""
    import os

    from regiflow.plans.monthly import run_counters
    from regiflow.schema import typed_schema
    raw, work = str(tmp_path / "raw"), str(tmp_path / "work")
    comp = csv_lines(spark, SF_SMALL)
    for i in range(4):
        write_zip(f"{raw}/2025-06/Empresas{i}.zip", {"a.csv": comp[:50] if i else comp[50:90]})
    with open(f"{raw}/2025-06/Empresas1.zip", "wb") as f:
        f.write(b"no archive")
    write_zip(f"{raw}/2025-06/Empresas2.zip", {"a.csv": []})
    path = f"{raw}/2025-06/Empresas3.zip"
    with open(path, "rb") as f:
        data = bytearray(f.read())
    data[60] ^= 0xFF                                             # inside the compressed member
    with open(path, "wb") as f:
        f.write(data)
    runs = run_month(spark, raw, work, "2025-06")
    out = {r["file_name"]: r for r in runs.collect()}
    assert out["Empresas0.zip"]["outcome"] == "loaded" and out["Empresas0.zip"]["rows"] == 40
    assert [out[f"Empresas{i}.zip"]["outcome"] for i in (1, 2, 3)] == ["error"] * 3
    assert tuple(run_counters(runs).first()) == (1, 0, 3, 40)
    state = {r["file_name"]: (r["status"], r["error_message"]) for r in current_state(spark, f"{work}/control_log").collect()}
    assert state["Empresas0.zip"] == ("loaded", None) and all(state[f"Empresas{i}.zip"][0] == "error" for i in (1, 2, 3))
    gold = spark.read.parquet(f"{work}/warehouse/empresas")
    want = {f.name: f.dataType for f in typed_schema("Empresas").fields}
    assert {f.name: f.dataType for f in gold.schema.fields if f.name in want} == want and gold.count() == 40
    # repaired files are taken up by the next run, and nothing is loaded twice
    write_zip(f"{raw}/2025-06/Empresas1.zip", {"a.csv": comp[:50]})
    again = {r["file_name"]: r["outcome"] for r in run_month(spark, raw, work, "2025-06").collect()}
    assert again["Empresas1.zip"] == "loaded" and "Empresas0.zip" not in again
    assert spark.read.parquet(f"{work}/warehouse/empresas").count() == 90
    assert os.path.isdir(f"{work}/rejects/empresas")


def test_named_files_and_force(spark, tmp_path):
    raw, work = str(tmp_path / "raw"), str(tmp_path / "work")
    comp = csv_lines(spark, SF_SMALL)
    write_zip(f"{raw}/2025-06/Empresas0.zip", {"a.csv": comp[:30]})
    write_zip(f"{raw}/2025-06/Empresas1.zip", {"a.csv": comp[30:50]})
    first = run_month(spark, raw, work, "2025-06", only=["Empresas1.zip"])
    assert [(r["file_name"], r["rows"]) for r in first.collect()] == [("Empresas1.zip", 20)]
    write_zip(f"{raw}/2025-06/Empresas1.zip", {"a.csv": comp[30:45]})            # replaced by its publisher
    assert run_month(spark, raw, work, "2025-06", only=["Empresas1.zip"]).count() == 0
    again = run_month(spark, raw, work, "2025-06", only=["Empresas1.zip"], force=True)
    assert [(r["file_name"], r["rows"]) for r in again.collect()] == [("Empresas1.zip", 15)]
    assert spark.read.parquet(f"{work}/warehouse/empresas").count() == 15          # its rows are replaced, the other file waits
