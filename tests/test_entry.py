"""Driver contract smoke test."""

import importlib.util
import os


def load_entry():
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    mod = load_entry()
    df = mod.entry(spark)
    assert df.count() > 0
    assert df.columns == ["cnpj_basico", "razao_social", "natureza_juridica", "capital_social", "porte_empresa"]
    assert set(mod.oracle_sql()) <= set(mod.queries())
