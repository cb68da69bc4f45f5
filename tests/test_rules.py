"""Entity rules: the reference's own unit case and casting with rejects."""

from pyspark.sql import functions as F

from regiflow.operators.casting import rejects, to_typed
from regiflow.operators.rules import apply_rules, normalize
from tests.conftest import rows


def test_reference_unit_case(spark):
    df = spark.createDataFrame(
        [("123456", " EMPRESA TESTE LTDA ", "1000,50"), ("12345678", " OUTRA EMPRESA S.A.", "250000,00")],
        "cnpj_basico string, razao_social string, capital_social string")
    out = rows(apply_rules(df, "Empresas"), ["cnpj_basico"])
    assert [r["cnpj_basico"] for r in out] == ["00123456", "12345678"]
    assert [r["razao_social"] for r in out] == ["EMPRESA TESTE LTDA", "OUTRA EMPRESA S.A."]
    assert [r["capital_social"] for r in out] == [1000.50, 250000.00]


def test_null_key_stays_null_and_bad_capital_is_per_row(spark):
    df = spark.createDataFrame([(None, "NULL", "abc"), ("1", "A", "5,5")],
                               "cnpj_basico string, razao_social string, capital_social string")
    out = rows(normalize(df, "Empresas"), ["capital_social"])
    assert out[0] == {"cnpj_basico": None, "razao_social": None, "capital_social": None}
    assert out[1]["capital_social"] == 5.5 and out[1]["cnpj_basico"] == "00000001"


def test_missing_columns_tolerated(spark):
    df = spark.createDataFrame([("7",)], "cnpj_basico string")
    assert rows(apply_rules(df, "Simples")) == [{"cnpj_basico": "00000007"}]


def test_lookups_pass_through(spark):
    df = spark.createDataFrame([("1", " x ")], "codigo string, descricao string")
    assert rows(apply_rules(df, "Paises")) == [{"codigo": "1", "descricao": " x "}]


def test_typed_and_rejects(spark):
    df = spark.createDataFrame(
        [("123456789", "1.000,50", "20231345"), ("00000001", "10,5", "20230101")],
        "cnpj_basico string, capital_social string, data_opcao_simples string")
    typed = rows(to_typed(df.select("cnpj_basico", "capital_social"), "Empresas"), ["cnpj_basico"])
    assert str(typed[0]["capital_social"]) == "10.50" and typed[1]["capital_social"] is None
    rej = rows(rejects(df.select("cnpj_basico", "capital_social"), "Empresas"), ["column_name"])
    assert [(r["column_name"], r["reason"]) for r in rej] == [("capital_social", "invalid_decimal"),
                                                             ("cnpj_basico", "too_long_8")]
    rej2 = rows(rejects(df.select("cnpj_basico", "data_opcao_simples"), "Simples"), ["column_name"])
    assert [(r["column_name"], r["reason"]) for r in rej2] == [("cnpj_basico", "too_long_8"),
                                                              ("data_opcao_simples", "invalid_date")]
    # silver rows = typed rows (rejects only explain the nulls)
    assert to_typed(df, "Simples").count() == df.count()


def test_search_escape_and_bounds(spark):
    import pytest
    from regiflow.operators import registry
    from regiflow.plans import silver
    from tests.conftest import SF_SMALL
    c = silver.companies(spark, SF_SMALL)
    assert registry.search_name(c, "er#0000000_").count() > 0          # '_' is a wildcard by default
    assert registry.search_name(c, "er#0000000_", escape=True).count() == 0
    with pytest.raises(ValueError):
        registry.search_name(c, "ab")
    with pytest.raises(ValueError):
        registry.list_page(c, limit=101)
    with pytest.raises(ValueError):
        registry.list_page(c, offset=-1)
    assert registry.lookup_key(c, "99999999").count() == 0             # not found
