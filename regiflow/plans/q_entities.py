"""Queries: entity rules, typed casting, file routing, registry lookups."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiflow.functions import text as TX
from regiflow.operators import registry
from regiflow.operators.casting import rejects
from regiflow.plans import oracle as O
from regiflow.plans import silver
from regiflow.plans import standins as S
from regiflow.plans.catalog import register
from regiflow.schema import TYPED
from regiflow.sources.tables import table

# Fixed query parameters of the registered registry queries.
SEARCH_TERM = "er#0000000"
PAGE_LIMIT, PAGE_OFFSET = 20, 40
LOOKUP_KEY = "00000042"

# --- entity rules -----------------------------------------------------------

register("normalize_companies", O.companies_sql(), "ENT1 STR1-4 SRC1")(silver.companies)
register("normalize_establishments", O.establishments_sql(), "ENT2 STR3 DAT1")(silver.establishments)
register("normalize_partners", O.partners_sql(), "ENT3 DAT1")(silver.partners)
register("normalize_simples", O.simples_sql(), "ENT4 DAT1")(silver.simples)


def _typed_dates_sql(cols: list[str], src: str) -> str:
    return "SELECT cnpj_basico, " + ", ".join(f"{O.date_typed(c)} AS {c}" for c in cols) + f" FROM ({src}) s"


@register("typed_simples_dates", _typed_dates_sql(
    ["data_opcao_simples", "data_exclusao_simples", "data_opcao_mei", "data_exclusao_mei"], O.simples_sql()),
    "DAT1 typed form CST1")
def typed_simples_dates(spark, sf):
    from regiflow.operators.casting import to_typed
    df = silver.simples(spark, sf)
    typed = to_typed(df, "Simples")
    return typed.select("cnpj_basico", "data_opcao_simples", "data_exclusao_simples", "data_opcao_mei",
                        "data_exclusao_mei")


def _rejects_sql(entity: str, src: str) -> str:
    parts = []
    for c, (t, n) in TYPED[entity].items():
        if c not in _present(entity):
            continue
        if isinstance(t, T.DateType):
            bad = f"{c} IS NOT NULL AND {O.date_typed(c)} IS NULL AND {O.date_text(c)} IS NOT NULL"
            reason = "invalid_date"
        elif isinstance(t, T.DecimalType):
            bad = f"{c} IS NOT NULL AND TRY_CAST(replace({O.strip(c)}, ',', '.') AS DECIMAL(15,2)) IS NULL"
            reason = "invalid_decimal"
        elif isinstance(t, T.IntegerType):
            bad = f"{c} IS NOT NULL AND TRY_CAST({O.strip(c)} AS INTEGER) IS NULL"
            reason = "invalid_int"
        else:
            bad, reason = "FALSE", None
        case = f"CASE WHEN {bad} THEN '{reason}'" if reason else "CASE WHEN FALSE THEN NULL"
        if n is not None:
            case += f" WHEN length({c}) > {n} THEN 'too_long_{n}'"
        case += " END"
        parts.append(f"SELECT {O.zfill('cnpj_basico')} AS record_key, '{c}' AS column_name, {c} AS raw_value, "
                     f"{case} AS reason, '{entity}' AS entity FROM ({src}) s")
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") r WHERE reason IS NOT NULL"


def _present(entity: str) -> list[str]:
    return S.RAW_COLUMNS[entity]


def _na_text_sql(src: str, entity: str) -> str:
    return "SELECT " + ", ".join(f"{O.na(c)} AS {c}" for c in _present(entity)) + f" FROM ({src}) r"


@register("typed_cast_rejects",
          _rejects_sql("Empresas", _na_text_sql(O.RAW_COMPANIES, "Empresas")) + " UNION ALL " +
          _rejects_sql("Estabelecimentos", _na_text_sql(O.RAW_ESTABLISHMENTS, "Estabelecimentos")),
          "CST1 ENT7 typed load with reject table")
def typed_cast_rejects(spark, sf):
    def one(df, entity):
        df = df.withColumn("cnpj_basico", TX.zfill("cnpj_basico"))
        return rejects(df, entity).withColumn("entity", F.lit(entity))
    return one(silver.companies_text(spark, sf), "Empresas").unionByName(
        one(silver.establishments_text(spark, sf), "Estabelecimentos"))


# --- file routing -----------------------------------------------------------

@register("file_type_routing", f"""
SELECT file_name, {O.file_type('file_name')} AS file_type,
  {O.file_type('file_name')} IN ({O.in_list(list(TYPED))}) AS mapped,
  replace(file_name, '.zip', '.parquet') AS parquet_file,
  {O.table_name("replace(file_name, '.zip', '.parquet')")} AS table_name,
  'raw/' || year_month || '/' || file_name AS raw_key
FROM ({O.CONTROL}) c""", "STR6 STR7 STR8 SNK10 ENT7")
def file_type_routing(spark, sf):
    c = S.control(spark, sf)
    return c.select(
        "file_name", TX.file_type("file_name").alias("file_type"), TX.is_mapped("file_name").alias("mapped"),
        TX.parquet_name("file_name").alias("parquet_file"),
        TX.table_name(TX.parquet_name("file_name")).alias("table_name"),
        TX.object_key("raw", F.col("year_month"), F.col("file_name")).alias("raw_key"))


# --- registry queries ---------------------------------------------------------

_LIST_SQL = "cnpj_basico, razao_social, natureza_juridica, capital_social, porte_empresa"


@register("company_total", f"SELECT count(*) AS total FROM ({O.companies_sql()}) c", "AGG4 QRY1 total")
def company_total(spark, sf):
    return registry.total(silver.companies(spark, sf))


@register("list_page", f"""
SELECT {_LIST_SQL} FROM ({O.companies_sql()}) c
ORDER BY cnpj_basico NULLS LAST, razao_social NULLS LAST, natureza_juridica NULLS LAST, capital_social NULLS LAST, porte_empresa NULLS LAST LIMIT {PAGE_LIMIT} OFFSET {PAGE_OFFSET}""", "QRY1 SRT3 PRJ1")
def list_page(spark, sf):
    return registry.list_page(silver.companies(spark, sf), PAGE_LIMIT, PAGE_OFFSET)


@register("search_name", f"""
SELECT {_LIST_SQL} FROM ({O.companies_sql()}) c
WHERE razao_social ILIKE '%{SEARCH_TERM}%' ORDER BY cnpj_basico NULLS LAST, razao_social NULLS LAST, natureza_juridica NULLS LAST, capital_social NULLS LAST, porte_empresa NULLS LAST LIMIT {PAGE_LIMIT}""", "QRY2 FLT2 SRT4")
def search_name(spark, sf):
    return registry.search_name(silver.companies(spark, sf), SEARCH_TERM, PAGE_LIMIT)


@register("search_all", f"""
SELECT {_LIST_SQL} FROM ({O.companies_sql()}) c WHERE razao_social ILIKE '%{SEARCH_TERM}%'""",
          "FLT2 whole result")
def search_all(spark, sf):
    return registry.search_all(silver.companies(spark, sf), SEARCH_TERM)


@register("lookup_key", f"""
SELECT cnpj_basico, razao_social, natureza_juridica, qualificacao_responsavel, capital_social,
  porte_empresa, ente_federativo_responsavel
FROM ({O.companies_sql()}) c WHERE cnpj_basico = '{LOOKUP_KEY}'""", "QRY3 FLT1")
def lookup_key(spark, sf):
    return registry.lookup_key(silver.companies(spark, sf), LOOKUP_KEY)


@register("lookup_enrich", f"""
SELECT c.*, n.descricao AS natureza_descricao, r.r_name
FROM ({O.companies_sql()}) c
LEFT JOIN ({O.NATUREZAS}) n ON c.natureza_juridica = n.codigo
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""", "code lookups (implied joins)")
def lookup_enrich(spark, sf):
    return registry.enrich_codes(silver.companies(spark, sf), S.lookup_naturezas(spark, sf),
                                 S.lookup_regions(spark, sf))


@register("content_hash", "SELECT doc_id, sha256(text) AS content_sha256, n_chars FROM documents", "HSH1")
def content_hash(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.sha2(F.col("text"), 256).alias("content_sha256"), "n_chars")


WILDCARD_TERM = "er#0000000_"
AFTER_KEY = "00000500"


@register("search_wildcard", f"""
SELECT {_LIST_SQL} FROM ({O.companies_sql()}) c
WHERE razao_social ILIKE '%{WILDCARD_TERM}%' ORDER BY cnpj_basico NULLS LAST, razao_social NULLS LAST, natureza_juridica NULLS LAST, capital_social NULLS LAST, porte_empresa NULLS LAST LIMIT {PAGE_LIMIT}""",
          "QRY2 FLT2 '_' in the term is a wildcard (D22 default)")
def search_wildcard(spark, sf):
    return registry.search_name(silver.companies(spark, sf), WILDCARD_TERM, PAGE_LIMIT)


@register("list_page_keyset", f"""
SELECT {_LIST_SQL} FROM ({O.companies_sql()}) c WHERE cnpj_basico > '{AFTER_KEY}'
ORDER BY cnpj_basico NULLS LAST, razao_social NULLS LAST, natureza_juridica NULLS LAST, capital_social NULLS LAST, porte_empresa NULLS LAST LIMIT {PAGE_LIMIT}""", "QRY1 SRT3 keyset paging")
def list_page_keyset(spark, sf):
    return registry.list_page(silver.companies(spark, sf), PAGE_LIMIT, after_key=AFTER_KEY)


@register("lookup_batch", f"""
SELECT cnpj_basico, razao_social, natureza_juridica, qualificacao_responsavel, capital_social,
  porte_empresa, ente_federativo_responsavel
FROM ({O.companies_sql()}) c
WHERE cnpj_basico IN (SELECT cnpj_basico FROM ({O.simples_sql()}) s WHERE opcao_pelo_simples = 'S')""",
          "QRY3 batch lookup (semi join) FLT8")
def lookup_batch(spark, sf):
    keys = silver.simples(spark, sf).where(F.col("opcao_pelo_simples") == "S").select("cnpj_basico")
    return registry.lookup_keys(silver.companies(spark, sf), keys)
