"""Control state machine, dashboard edge cases and quality rules (F2, F7, F8)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from regiflow.operators import control as C
from regiflow.operators import quality as Q
from regiflow.schema import CONTROL_SCHEMA, STATUSES
from tests.conftest import rows


def control_rows(spark):
    t = dt.datetime(2025, 6, 1)
    data = [("2025-06", f"Empresas{i}.zip", 100 * i if i else None, "e", None, None, 0.0, t, None, s, None)
            for i, s in enumerate(STATUSES)]
    data.append(("BASE", "Cnaes.zip", 10, "e", None, None, 0.0, t, None, "pending", None))
    return spark.createDataFrame(data, CONTROL_SCHEMA)


def test_empty_control_dashboard(spark):
    empty = spark.createDataFrame([], CONTROL_SCHEMA)
    s = rows(C.dashboard_summary(empty))
    assert s == [{"total_months": 0, "total_files": 0, "total_size_bytes": 0, "total_pending": 0, "total_loaded": 0,
                  "total_size_gb": 0.0}]
    assert C.dashboard_month(empty).count() == 0


def test_dashboard_counts_add_up(spark):
    c = control_rows(spark)
    m = {r["year_month"]: r for r in C.dashboard_month(c).collect()}
    assert m["2025-06"]["total_files"] == 7 and sum(m["2025-06"][f"n_{s}"] for s in STATUSES) == 7
    assert m["2025-06"]["total_size_bytes"] == sum(100 * i for i in range(7))
    s = C.dashboard_summary(c).first()
    assert (s["total_months"], s["total_files"], s["total_pending"], s["total_loaded"]) == (2, 8, 2, 1)


def test_progress_classes(spark):
    p = {r["file_name"]: r["progress_class"] for r in C.progress(control_rows(spark), "2025-06").collect()}
    assert p == {"Empresas0.zip": "pending", "Empresas1.zip": "downloading", "Empresas2.zip": "completed",
                 "Empresas3.zip": "pending", "Empresas4.zip": "completed", "Empresas5.zip": "completed",
                 "Empresas6.zip": "errored"}


def test_event_log_latest_state_and_transitions(spark, tmp_path):
    c = control_rows(spark)
    ev0 = c.withColumn("event_time", F.col("discovered_at")).withColumn("seq", F.lit(0).cast("long"))
    log = str(tmp_path / "log")
    C.append_events(ev0, log)
    cur = C.latest_state(C.read_log(spark, log))
    moved, rejected = C.transition(cur, "downloaded", allowed_from=["pending", "downloading", "error"],
                                   event_time=F.lit(dt.datetime(2025, 6, 2)))
    assert rejected.count() == 4 and moved.count() == 4
    C.append_events(moved.withColumn("seq", F.lit(1).cast("long")).select(*ev0.columns), log)
    now = {(r["year_month"], r["file_name"]): r["status"] for r in C.latest_state(C.read_log(spark, log)).collect()}
    assert now[("BASE", "Cnaes.zip")] == "downloaded" and now[("2025-06", "Empresas5.zip")] == "loaded"
    # re-appending the same events changes nothing about the latest state
    C.append_events(moved.withColumn("seq", F.lit(1).cast("long")).select(*ev0.columns), log)
    again = {(r["year_month"], r["file_name"]): r["status"] for r in C.latest_state(C.read_log(spark, log)).collect()}
    assert again == now


def test_first_of_type(spark):
    files = spark.createDataFrame([("m", n) for n in ["Empresas1.zip", "Empresas0.zip", "Socios3.zip", "Socios10.zip",
                                                      "Outros.zip"]], "year_month string, file_name string")
    got = {r["file_type"]: r["file_name"] for r in C.first_of_type(files).collect()}
    assert got == {"Empresas": "Empresas0.zip", "Socios": "Socios10.zip", "Outros": "Outros.zip"}


def test_quality_rules_pass_and_fail(spark):
    ok = spark.createDataFrame([("12345678", "S"), ("00000001", None)], "cnpj_basico string, opcao_pelo_simples string")
    bad = spark.createDataFrame([(None, "X"), ("123", " ")], "cnpj_basico string, opcao_pelo_simples string")
    r_ok = Q.run_suite(ok, "empresas", Q.COMPANY_SUITE).unionByName(Q.run_suite(ok, "simples", Q.SIMPLES_SUITE))
    Q.assert_checkpoint(r_ok)
    r_bad = Q.run_suite(bad, "empresas", Q.COMPANY_SUITE).unionByName(Q.run_suite(bad, "simples", Q.SIMPLES_SUITE))
    got = {r["expectation"]: r["unexpected_count"] for r in r_bad.collect()}
    # nulls do not fail the length and set rules
    assert got == {"expect_column_values_to_not_be_null": 1, "expect_column_value_lengths_to_equal": 1,
                   "expect_column_values_to_be_in_set": 1}
    with pytest.raises(AssertionError):
        Q.assert_checkpoint(r_bad)
    assert {r["suite"]: r["success"] for r in Q.checkpoint(r_bad).collect()} == {"empresas": False, "simples": False}


def test_approx_profile_matches_exact_on_small_data(spark):
    from regiflow.operators import profile as P
    from regiflow.plans import silver
    from tests.conftest import SF_SMALL
    df = silver.companies_text(spark, SF_SMALL)
    exact = {r["column_name"]: r for r in P.profile_columns(df).collect()}
    approx = {r["column_name"]: r for r in P.profile_columns_approx(df).collect()}
    assert exact.keys() == approx.keys()
    for c in exact:
        assert exact[c]["null_count"] == approx[c]["null_count"]
        assert exact[c]["row_count"] == approx[c]["row_count"]
        assert abs(exact[c]["unique_count"] - approx[c]["unique_count"]) <= max(2, 0.05 * exact[c]["unique_count"])
        if exact[c]["sample_values"]:
            assert exact[c]["sample_values"].split(" | ")[0] == approx[c]["sample_values"]


def test_model_save_load_and_run_log(spark, tmp_path):
    from regiflow.operators import ml as M
    from regiflow.plans import silver
    from tests.conftest import SF_SMALL
    data = M.training_set_simples(silver.companies(spark, SF_SMALL), silver.simples(spark, SF_SMALL))
    train, test = M.split(data)
    assert train.count() + test.count() == data.count()
    model = M.train_simples(train)
    path = M.save_model(model, str(tmp_path), "rf")
    scored = M.score(M.load_model(path), test)
    assert scored.count() == test.count()
    metrics = M.binary_metrics(M.load_model(path).transform(test))
    M.log_run(metrics, {"numTrees": 100, "maxDepth": 10}, str(tmp_path / "runs"))
    M.log_run(metrics, {"numTrees": 100, "maxDepth": 10}, str(tmp_path / "runs"))
    runs = spark.read.parquet(str(tmp_path / "runs"))
    assert runs.count() == 2 and {"accuracy", "f1", "numTrees", "run_at"} <= set(runs.columns)
