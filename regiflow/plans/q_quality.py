"""Queries: data-quality suites, checkpoint, column profile, issue rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from regiflow.operators import profile as P
from regiflow.operators import quality as Q
from regiflow.plans import oracle as O
from regiflow.plans import silver
from regiflow.plans import standins as S
from regiflow.plans.catalog import register
from regiflow.schema import DOWNLOADED_OR_LATER, LAYOUTS, SIMPLES_OPTION_VALUES

_COMP = f"({O.companies_sql()})"
_SIMP = f"({O.simples_sql()})"
_TEXT_COLS = S.RAW_COLUMNS["Empresas"]
_COMP_TEXT = "(SELECT " + ", ".join(f"{O.na(c)} AS {c}" for c in _TEXT_COLS) + f" FROM ({O.RAW_COMPANIES}) r)"


def _suite_sql(suite: str, src: str, parts: list[tuple[str, str, str, str]]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT {i} AS idx, '{name}' AS expectation, '{col}' AS column_name, count(*) AS element_count, "
        f"count(*) FILTER (WHERE {checked}) AS checked_count, count(*) FILTER (WHERE {bad}) AS unexpected_count "
        f"FROM {src} t"
        for i, (name, col, checked, bad) in enumerate(parts))
    return (f"SELECT '{suite}' AS suite, idx, expectation, column_name, element_count, checked_count, "
            f"unexpected_count, unexpected_count = 0 AS success FROM ({rows}) x")


_COMPANY_SUITE_SQL = _suite_sql("empresas", _COMP, [
    ("expect_column_values_to_not_be_null", "cnpj_basico", "TRUE", "cnpj_basico IS NULL"),
    ("expect_column_value_lengths_to_equal", "cnpj_basico", "cnpj_basico IS NOT NULL",
     "cnpj_basico IS NOT NULL AND length(cnpj_basico) <> 8"),
])
_SIMPLES_SUITE_SQL = _suite_sql("simples", _SIMP, [
    ("expect_column_values_to_be_in_set", "opcao_pelo_simples", "opcao_pelo_simples IS NOT NULL",
     f"opcao_pelo_simples IS NOT NULL AND opcao_pelo_simples NOT IN ({O.in_list(SIMPLES_OPTION_VALUES)})"),
])


@register("quality_companies", _COMPANY_SUITE_SQL, "DQ1 DQ2")
def quality_companies(spark, sf):
    return Q.run_suite(silver.companies(spark, sf), "empresas", Q.COMPANY_SUITE)


@register("quality_simples", _SIMPLES_SUITE_SQL, "DQ3")
def quality_simples(spark, sf):
    return Q.run_suite(silver.simples(spark, sf), "simples", Q.SIMPLES_SUITE)


@register("quality_checkpoint", f"""
SELECT suite, bool_and(success) AS success, count(*) AS expectations, count(*) FILTER (WHERE NOT success) AS failed
FROM ({_COMPANY_SUITE_SQL} UNION ALL {_SIMPLES_SUITE_SQL}) r GROUP BY 1""", "DQ4 checkpoint")
def quality_checkpoint(spark, sf):
    return Q.checkpoint(quality_companies(spark, sf).unionByName(quality_simples(spark, sf)))


def _profile_sql(src: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(f"""
SELECT '{c}' AS column_name, count(*) AS row_count, count(*) FILTER (WHERE {c} IS NULL) AS null_count,
  count(DISTINCT {c}) AS unique_count,
  (SELECT string_agg(v, ' | ' ORDER BY v) FROM (SELECT DISTINCT {c} AS v FROM {src} s2 WHERE {c} IS NOT NULL
     ORDER BY v LIMIT {P.SAMPLE_VALUES}) x) AS sample_values
FROM {src} s1""")
    return f"""
SELECT column_name, row_count, null_count, unique_count, sample_values,
  CASE WHEN row_count = 0 THEN 'N/A' ELSE printf('%.1f%%', round(100.0 * null_count / row_count, 1)) END AS null_pct,
  null_count = row_count AND row_count > 0 AS all_null
FROM ({" UNION ALL ".join(parts)}) p"""


@register("profile_columns", _profile_sql(_COMP_TEXT, _TEXT_COLS), "DQ5 AGG8 AGG9 AGG10 STR15")
def profile_columns(spark, sf):
    return P.profile_columns(silver.companies_text(spark, sf))


@register("profile_capital", f"""
SELECT 'capital_social' AS column_name, count(*) FILTER (WHERE capital_social IS NOT NULL) AS non_null,
  count(*) FILTER (WHERE capital_social IS NOT NULL AND {O.decimal_comma('capital_social')} IS NULL) AS unparsable,
  min({O.decimal_comma('capital_social')}) AS min, max({O.decimal_comma('capital_social')}) AS max,
  count(*) FILTER (WHERE {O.decimal_comma('capital_social')} = 0) AS zeros,
  count(*) FILTER (WHERE {O.decimal_comma('capital_social')} < 0) AS negatives
FROM {_COMP_TEXT} t""", "AGG11 STR4")
def profile_capital(spark, sf):
    return P.profile_number(silver.companies_text(spark, sf), "capital_social")


@register("key_length_hist", f"""
SELECT CAST(length(cnpj_basico) AS INTEGER) AS key_length, count(*) AS n, length(cnpj_basico) = 8 AS expected
FROM {_COMP_TEXT} t WHERE cnpj_basico IS NOT NULL GROUP BY 1, 3""", "AGG12 STR17")
def key_length_hist(spark, sf):
    return P.key_length_hist(silver.companies_text(spark, sf))


@register("key_lengths_ok", f"""
SELECT bool_and(length(cnpj_basico) = 8) AS lengths_ok, count(DISTINCT length(cnpj_basico)) AS distinct_lengths
FROM {_COMP} t WHERE cnpj_basico IS NOT NULL""", "SET6 subset of expected lengths")
def key_lengths_ok(spark, sf):
    return P.key_lengths_ok(P.key_length_hist(silver.companies(spark, sf)))


def _issues_sql(src: str, cols: list[str]) -> str:
    rules = [
        ("issue", "negative_values", "capital_social", f"count(*) FILTER (WHERE {O.decimal_comma('capital_social')} < 0)"),
        ("issue", "null_key", "cnpj_basico", "count(*) FILTER (WHERE cnpj_basico IS NULL)"),
        ("warning", "unexpected_key_length", "cnpj_basico",
         "count(*) FILTER (WHERE cnpj_basico IS NOT NULL AND length(cnpj_basico) <> 8)"),
        ("issue", "non_latin1_text", "razao_social",
         "count(*) FILTER (WHERE regexp_matches(razao_social, '[^\\x{0}-\\x{ff}]'))"),
    ] + [("warning", "all_null_column", c,
          f"CASE WHEN count({c}) = 0 AND count(*) > 0 THEN count(*) ELSE 0 END") for c in cols]
    parts = " UNION ALL ".join(f"SELECT '{s}' AS severity, '{code}' AS code, '{c}' AS column_name, "
                               f"CAST({n} AS BIGINT) AS n FROM {src} t" for s, code, c, n in rules)
    return f"SELECT * FROM ({parts}) r WHERE n > 0"


@register("profile_issues", _issues_sql(_COMP_TEXT, _TEXT_COLS), "DQ6 STR16")
def profile_issues(spark, sf):
    return P.profile_issues(silver.companies_text(spark, sf))


@register("capacity_estimate", f"""
SELECT year_month, count(*) AS files, count(*) FILTER (WHERE mapped) AS mapped,
  count(*) FILTER (WHERE NOT mapped) AS unmapped, CAST(sum(sz) AS BIGINT) AS total_raw_bytes,
  round(sum(sz) * 7.0 / 1048576.0, 1) AS estimated_ram_mb,
  round(sum(sz) * 1.75 / 1073741824.0, 1) AS estimated_parquet_gb
FROM (SELECT year_month, coalesce(local_size_bytes, 0) AS sz,
        {O.file_type('file_name')} IN ({O.in_list(list(LAYOUTS))}) AS mapped
      FROM ({O.CONTROL}) c WHERE status IN ({O.in_list(DOWNLOADED_OR_LATER)})) f
GROUP BY 1""", "DQ7 MTH3")
def capacity_estimate(spark, sf):
    files = S.control(spark, sf).where(F.col("status").isin(DOWNLOADED_OR_LATER))
    return P.file_profile(files)


@register("profile_all_entities", f"""
{_profile_sql(f"({O.simples_sql()})", ['cnpj_basico', 'opcao_pelo_simples', 'data_opcao_simples', 'opcao_mei'])}""",
          "DQ5 over a second entity")
def profile_all_entities(spark, sf):
    return P.profile_columns(silver.simples(spark, sf), ["cnpj_basico", "opcao_pelo_simples", "data_opcao_simples",
                                                         "opcao_mei"])

