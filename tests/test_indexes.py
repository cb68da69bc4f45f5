"""Search, page and lookup structures against the plain queries."""

import random

import pytest

from regiflow.operators import pages, registry, trigrams
from regiflow.schema import LAYOUTS
from regiflow.sinks.layout import bucket_count, write_keyed


@pytest.fixture(scope="module")
def companies(spark):
    r = random.Random(3)
    words = ["Padaria", "AÇÃO", "100%", "a_b", "İstanbul", "x\\y", "CAFÉ", "loja", "ss", "", "ABC"]
    rows = []
    for i in range(3000):
        name = None if i % 97 == 0 else " ".join(r.choice(words) for _ in range(r.randrange(0, 5))) + str(i % 700)
        key = None if i % 211 == 0 else f"{r.randrange(900):08d}"
        rows.append((key, name, str(i % 9), None, float(i % 13), "01", None))
    rows += [("00000500", "same", "1", None, 1.0, "01", None)] * 300              # repeated rows
    schema = ", ".join(f"{c} {'double' if c == 'capital_social' else 'string'}" for c in LAYOUTS["Empresas"])
    return spark.createDataFrame(rows, schema).repartition(5).persist()


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_trigram_search_finds_what_a_scan_finds(spark, companies, tmp_path):
    index = trigrams.build(companies, str(tmp_path / "i"), block_rows=64)
    assert index.rows.select("_block").distinct().count() > 40
    for term in ("padaria", "ação", "Café L", "a_b", "100%", "%loja%", "ia_1", "x%y", "699", "istanbul", "İst", "abc abc", "nowhere", "___", "a%b", "same"):
        assert same(trigrams.search(index, term), registry.search_all(companies, term)), term
        if term not in ("x\\y",):
            assert same(trigrams.search(index, term, escape=True), registry.search_all(companies, term, escape=True)), term
    assert same(trigrams.search(index, "x\\\\y"), registry.search_all(companies, "x\\\\y"))
    with pytest.raises(ValueError):
        trigrams.search(index, "ab")
    blocks = trigrams.candidate_blocks(index, trigrams.term_grams(spark, "İstanbul CAFÉ"))
    assert 0 < blocks.count() < index.rows.select("_block").distinct().count()
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and "In(gram" in plan                # only the term's postings


def test_trigram_index_of_nothing(spark, companies, tmp_path):
    index = trigrams.build(companies.limit(0), str(tmp_path / "none"))
    assert trigrams.search(index, "padaria").count() == 0
    assert pages.page(pages.build(companies.limit(0), str(tmp_path / "nopages")), 10, 5).count() == 0


def test_deep_pages_equal_the_sort(spark, companies, tmp_path):
    index = pages.build(companies, str(tmp_path / "p"), range_rows=400)
    total = companies.count()
    ranges = index.starts.count()
    assert ranges > 4
    for offset in (0, 1, 399, 400, 1234, total - 10, total, total + 5):
        assert [tuple(r) for r in pages.page(index, 37, offset).collect()] == [
            tuple(r) for r in registry.list_page(companies, 37, offset).collect()], offset
    read = pages.page(index, 20, 1234)._jdf.queryExecution().toString()
    assert "_range IN" in read or "_range#" in read
    hit = index.starts.where("first < 1254 and first + n > 1234").count()
    assert 1 <= hit <= 2 < ranges


def test_lookup_reads_one_bucket(spark, companies, tmp_path):
    table = write_keyed(companies, str(tmp_path / "k"), bucket_rows=200, name="keyed_test")
    n = bucket_count(companies.count(), 200)
    found = registry.lookup_key(table, "00000500")
    # files of other buckets are no input of the scan, also where the planner shows it as a plain one
    confs = {"spark.sql.files.openCostInBytes": str(1 << 30), "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        wide = registry.lookup_key(table, "00000500")._jdf.queryExecution().executedPlan().toString()
        assert f"SelectedBucketsCount: 1 out of {n}" in wide or f"SelectedBucketsCount: 1 out of {n}"[:20] in spark.table("keyed_test").where(
            "cnpj_basico = '00000500'").select("cnpj_basico")._jdf.queryExecution().executedPlan().toString()
        spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "true")
        assert spark.table("keyed_test").where("cnpj_basico = '00000500'").rdd.getNumPartitions() == 1 < spark.table("keyed_test").rdd.getNumPartitions()
    finally:
        for k in confs:
            spark.conf.unset(k)
    assert found.collect()[0]["cnpj_basico"] == "00000500"
    keys = companies.where("capital_social = 3.0").select("cnpj_basico")
    assert same(registry.lookup_keys(table, keys), registry.lookup_keys(companies, keys))
    assert registry.lookup_key(table, "none").count() == 0
    spark.sql("DROP TABLE keyed_test")
