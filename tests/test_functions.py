"""Scalar column functions, one table-driven case per trap."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from regiflow.functions import dates as D
from regiflow.functions import formats as FM
from regiflow.functions import numbers as N
from regiflow.functions import text as TX


def one_col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_zfill_never_truncates_and_is_sign_aware(spark):
    got = one_col(spark, ["123456", "123456789", "-5", "+7", "", None, "12345678"], TX.zfill)
    assert got == ["00123456", "123456789", "-0000005", "+0000007", "00000000", None, "12345678"]


def test_strip_unicode_whitespace(spark):
    vals = ["  EMPRESA\t", " OUTRA EMPRESA S.A.", "\x85X\x1c", "  ", "A B"]
    assert one_col(spark, vals, TX.strip_unicode) == ["EMPRESA", "OUTRA EMPRESA S.A.", "X", "", "A B"]


def test_trim_is_not_enough(spark):
    # Spark's trim keeps NBSP and TAB, the rule must not.
    assert one_col(spark, [" A\t"], F.trim) == [" A\t"]


def test_na_tokens(spark):
    vals = ["", "NA", "NULL", "nan", "None", "N/A", "#N/A", " ", "x"]
    assert one_col(spark, vals, TX.null_na_tokens) == [None] * 7 + [" ", "x"]


def test_na_tokens_by_name_matches_column_form(spark):
    from regiflow.schema import NA_TOKENS
    vals = [*NA_TOKENS, " ", "x", "na", "'", None]
    df = spark.createDataFrame([(v,) for v in vals], "`odd name``` string")
    by_name = [r[0] for r in df.select(TX.null_na_tokens("odd name`")).collect()]
    by_col = [r[0] for r in df.select(TX.null_na_tokens(F.col("`odd name```"))).collect()]
    assert by_name == by_col == [None] * len(NA_TOKENS) + [" ", "x", "na", "'", None]


def test_decimal_comma(spark):
    vals = ["1000,50", "250000,00", "-5,00", " 12,3 ", "1.000,50", "abc", None, "NaN"]
    got = one_col(spark, vals, N.decimal_comma)
    assert got == [1000.5, 250000.0, -5.0, 12.3, None, None, None, None]


def test_decimal_half_up(spark):
    got = one_col(spark, ["1000,505", "0,125"], lambda c: N.decimal_comma_decimal(c, 15, 2))
    assert [str(x) for x in got] == ["1000.51", "0.13"]


def test_digits_and_commas(spark):
    assert one_col(spark, ["12 ,A3;x,4", None], TX.digits_and_commas) == ["12,3,4", None]


@pytest.mark.parametrize("raw,text,typed", [
    (None, None, None), ("", None, None), ("None", None, None), ("nan", None, None), ("0", None, None),
    ("00000000", None, None), ("00/00/0000", None, None), ("20230101", "2023-01-01", dt.date(2023, 1, 1)),
    ("20230229", "2023-02-29", None), ("20231345", "2023-13-45", None), (" 2023/01/05 ", "2023/01/05", None),
])
def test_dates(spark, raw, text, typed):
    assert one_col(spark, [raw], D.normalize_date_text) == [text]
    assert one_col(spark, [raw], D.to_date_typed) == [typed]


@pytest.mark.parametrize("name,typ,table", [
    ("Empresas0.zip", "Empresas", "cnpj_empresas"), ("Empresas9.zip", "Empresas", "cnpj_empresas"),
    ("estabelecimentos3.ZIP", "Estabelecimentos", "cnpj_estabelecimentos"),
    ("Simples.zip", "Simples", "cnpj_simples"), ("Outros1.zip", "Outros", "cnpj_outros"),
    ("Cnaes.tar.gz", "Cnaes", "cnpj_cnaes"),
])
def test_file_routing(spark, name, typ, table):
    assert one_col(spark, [name], TX.file_type) == [typ]
    assert one_col(spark, [name], lambda c: TX.table_name(TX.parquet_name(c))) == [table]


def test_parquet_name_case_sensitive(spark):
    assert one_col(spark, ["a.zip", "b.ZIP"], TX.parquet_name) == ["a.parquet", "b.ZIP"]


@pytest.mark.parametrize("key,month,compat", [
    ("raw/2025-06/a.zip", "2025-06", "raw/2025-06"), ("processed/2025-06/a.parquet", "2025-06", "processed/2025-06"),
    ("2025-06/a.parquet", "2025-06", "2025-06"), ("a.zip", "ROOT", "ROOT"),
])
def test_month_of_key(spark, key, month, compat):
    assert one_col(spark, [key], TX.month_of_key) == [month]
    assert one_col(spark, [key], lambda c: TX.month_of_key(c, compat=True)) == [compat]


def test_human_bytes(spark):
    got = one_col(spark, [0, 1023, 1024, 1536, 1048576, 5 * 1024 ** 4, 3 * 1024 ** 5, None], FM.human_bytes, "long")
    assert got == ["0.0 B", "1023.0 B", "1.0 KB", "1.5 KB", "1.0 MB", "5.0 TB", "3.0 PB", None]


def test_eta_text(spark):
    got = one_col(spark, [-1.0, 0.0, 59.9, 61.0, 3723.0, 86401.0], FM.eta_text, "double")
    assert got == ["calculando...", "0s", "59s", "1m01s", "1h02m03s", "calculando..."]


def test_percent_text(spark):
    df = spark.createDataFrame([(1, 8), (0, 0), (1, 4)], "v long, t long")
    got = [r[0] for r in df.select(FM.percent_text("v", "t")).collect()]
    assert got == ["12.5%", "N/A", "25.0%"]


def test_strip_quotes_and_truncate(spark):
    assert one_col(spark, ['"abc"', "x"], TX.strip_quotes) == ["abc", "x"]
    assert one_col(spark, ["x" * 1200], lambda c: F.length(TX.truncate(c, 1000))) == [1000]


def test_non_latin1(spark):
    assert one_col(spark, ["ação", "Ω"], TX.has_non_latin1) == [False, True]
