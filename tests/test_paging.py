"""Paging reaches every row: listings by key, companies by row."""

from collections import Counter

from regiflow.operators import gaps, registry

PAGE = 7


def test_listing_pages(spark):
    keys = [f"raw/2025-06/File{i:03d}.zip" for i in range(23)] + ["processed/x", "raw"]
    store = spark.createDataFrame([(k, 1280, None, "e") for k in keys], "key string, size_bytes long, last_modified timestamp, etag string")
    seen, after = [], None
    while True:
        page = sorted(gaps.list_objects(store, "raw/", PAGE, after).collect(), key=lambda r: r.key)
        seen += [r.key for r in page]
        if not page or not page[0].is_truncated:
            break
        after = page[-1].key
    assert seen == sorted(k for k in keys if k.startswith("raw/")) and page[0].size_human == "1.2 KB"


def test_company_pages_with_null_and_repeated_keys(spark):
    rows = [(None if i % 5 == 0 else f"{i // 3:08d}", None if i % 4 == 0 else "n", None, float(i % 2), "01") for i in range(40)] * 2
    df = spark.createDataFrame(rows, "cnpj_basico string, razao_social string, natureza_juridica string, capital_social double, porte_empresa string")
    seen, last, ties = [], None, 0
    while True:
        page = [r.asDict() for r in registry.list_page(df, PAGE, after=last, ties=ties).collect()]
        if not page:
            break
        for r in page:
            ties = ties + 1 if r == last else 1
            last = r
        seen += page
    assert Counter(tuple(r.values()) for r in seen) == Counter(rows)
