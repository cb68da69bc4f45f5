"""Physical-plan properties the engine relies on at scale."""

import time

import pytest

from regiflow.plans import catalog
from tests.conftest import SF_SMALL

QUERIES = catalog.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"rf_simples", "rf_size", "batch_score"}))
def test_no_cartesian_or_nested_loop(spark, name):
    t0 = time.time()
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert time.time() - t0 < 30, "planning took too long (expression blow-up?)"
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", ["normalize_companies", "normalize_partners", "content_hash", "human_bytes"])
def test_cleaning_is_one_narrow_stage(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert "Exchange" not in p and "PythonUDF" not in p and "BatchEvalPython" not in p


def test_scan_prunes_columns(spark):
    df = QUERIES["content_hash"](spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "lang" not in text and "source" not in text.replace("DataSource", "")


def test_latest_state_is_an_aggregate_not_a_window(spark):
    p = plan(QUERIES["latest_state"](spark, SF_SMALL))
    assert "Window" not in p and "Aggregate" in p


def test_profile_samples_use_partial_group_limit(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(QUERIES["profile_columns"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"rf_simples", "rf_size", "batch_score"}))
def test_windows_are_group_limited(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(QUERIES[name](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    windows = p.count("Window [") + p.count("Window(")
    if windows:
        # every ranked window keeps at most n rows per group before its shuffle
        assert p.count("WindowGroupLimit") >= 2 * windows, p


def test_scale_conf_sizes_partitions():
    from regiflow.session import scale_conf
    c = scale_conf(100 << 40, 1000, 8)
    assert int(c["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert scale_conf(1 << 20, 10, 4)["spark.sql.shuffle.partitions"] == "80"
