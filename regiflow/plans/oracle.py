"""DuckDB SQL for the stand-in inputs and the column rules.

The correctness gate runs each registered Spark query next to an
independently written SQL statement over the same parquet tables.  This
module holds the SQL text shared by those statements: the stand-in inputs of
``regiflow.plans.standins`` and SQL forms of the cleaning rules.
"""

from __future__ import annotations

from regiflow.functions.text import WHITESPACE_CLASS
from regiflow.plans.standins import (
    FILE_PREFIXES, KNOWN_BEFORE, STORE_MISSING_MONTH, SITUATION_BY_STATUS, SIZE_BY_SEGMENT, STATUS_BY_MOD,
)
from regiflow.schema import DATE_NULL_TOKENS, NA_TOKENS


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return ", ".join(q(v) for v in values)


def case_map(expr: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {q(k) if isinstance(k, str) else k} THEN {q(v)}" for k, v in mapping.items())
    return f"CASE {expr} {whens} END"


def pick(expr: str, values: list[str]) -> str:
    return case_map(f"({expr}) % {len(values)}", dict(enumerate(values)))


# --- rules -----------------------------------------------------------------

def na(c: str) -> str:
    return f"CASE WHEN {c} IN ({in_list(NA_TOKENS)}) THEN NULL ELSE {c} END"


def strip(c: str) -> str:
    w = WHITESPACE_CLASS
    return f"regexp_replace({c}, '^{w}+|{w}+$', '', 'g')"


def zfill(c: str, width: int = 8) -> str:
    return (f"CASE WHEN length({c}) >= {width} THEN {c} "
            f"WHEN {c} LIKE '-%' OR {c} LIKE '+%' THEN substr({c}, 1, 1) || lpad(substr({c}, 2, {width}), {width - 1}, '0') "
            f"ELSE lpad({c}, {width}, '0') END")


def digits_commas(c: str) -> str:
    return f"regexp_replace({c}, '[^0-9,]', '', 'g')"


def decimal_comma(c: str) -> str:
    d = f"TRY_CAST(replace({strip(c)}, ',', '.') AS DOUBLE)"
    return f"CASE WHEN isnan({d}) THEN NULL ELSE {d} END"


def date_text(c: str) -> str:
    s = strip(c)
    return (f"CASE WHEN {c} IS NULL OR {s} IN ({in_list(DATE_NULL_TOKENS)}) THEN NULL "
            f"WHEN regexp_matches({s}, '^[0-9]{{8}}$') THEN substr({s}, 1, 4) || '-' || substr({s}, 5, 2) || '-' || substr({s}, 7, 2) "
            f"ELSE {s} END")


def date_typed(c: str) -> str:
    return f"TRY_CAST(try_strptime({date_text(c)}, '%Y-%m-%d') AS DATE)"


def file_type(c: str) -> str:
    from regiflow.schema import LAYOUTS
    base = f"regexp_replace({c}, '(?i)\\d*\\.zip|\\d*\\.tar\\.gz', '', 'g')"
    whens = " ".join(f"WHEN starts_with(lower({base}), {q(e.lower())}) THEN {q(e)}" for e in LAYOUTS)
    return f"CASE {whens} ELSE {base} END"


def table_name(c: str) -> str:
    from regiflow.schema import TABLES
    base = f"lower(regexp_replace({c}, '(?i)\\d*\\.parquet', '', 'g'))"
    whens = " ".join(f"WHEN starts_with({base}, {q(k)}) THEN {q(t)}" for k, t in TABLES.items())
    return f"CASE {whens} ELSE 'cnpj_' || {base} END"


def month_of_key(c: str, compat: bool = False) -> str:
    n = f"len(string_split({c}, '/'))"
    p0, p1 = f"split_part({c}, '/', 1)", f"split_part({c}, '/', 2)"
    month = f"{p0} || '/' || {p1}" if compat else p1
    return (f"CASE WHEN {n} >= 3 AND {p0} IN ('raw', 'processed') THEN {month} "
            f"WHEN {n} > 1 THEN {p0} ELSE 'ROOT' END")


def human_bytes(c: str) -> str:
    from regiflow.functions.formats import BYTE_LAST_UNIT, BYTE_STEP, BYTE_UNITS
    whens = []
    for i, unit in enumerate(BYTE_UNITS):
        scaled = f"(CAST({c} AS DOUBLE) / {BYTE_STEP ** i})"
        whens.append(f"WHEN abs({scaled}) < {BYTE_STEP} THEN printf('%.1f {unit}', {scaled})")
    last = f"printf('%.1f {BYTE_LAST_UNIT}', CAST({c} AS DOUBLE) / {BYTE_STEP ** len(BYTE_UNITS)})"
    return f"CASE WHEN {c} IS NULL THEN NULL {' '.join(whens)} ELSE {last} END"


# --- stand-in inputs -------------------------------------------------------

def _money(c: str) -> str:
    return f"replace(CAST(CAST({c} AS DECIMAL(15,2)) AS VARCHAR), '.', ',')"


RAW_COMPANIES = f"""
SELECT
  CASE WHEN c_custkey % 101 = 0 THEN NULL
       WHEN c_custkey % 103 = 0 THEN '9' || lpad(CAST(c_custkey AS VARCHAR), 8, '0')
       ELSE CAST(c_custkey AS VARCHAR) END AS cnpj_basico,
  CASE WHEN c_custkey % 50 = 0 THEN 'NULL'
       WHEN c_custkey % 7 = 0 THEN chr(160) || c_name || chr(9)
       ELSE '  ' || c_name || ' ' END AS razao_social,
  CAST(c_nationkey + 2000 AS VARCHAR) AS natureza_juridica,
  lpad(CAST(c_custkey % 50 AS VARCHAR), 2, '0') AS qualificacao_responsavel,
  CASE WHEN c_custkey % 41 = 0 THEN 'abc' WHEN c_custkey % 43 = 0 THEN ''
       WHEN c_custkey % 59 = 0 THEN '5d' WHEN c_custkey % 61 = 0 THEN '0x1p3'
       WHEN c_custkey % 37 = 0 THEN '1.000,50'
       WHEN c_custkey % 29 = 0 THEN ' ' || {_money('c_acctbal')} || ' '
       ELSE {_money('c_acctbal')} END AS capital_social,
  CASE WHEN c_custkey % 31 = 0 THEN '' ELSE {case_map('c_mktsegment', SIZE_BY_SEGMENT)} END AS porte_empresa,
  CASE WHEN c_custkey % 97 = 0 THEN 'UNIAO' ELSE '' END AS ente_federativo_responsavel
FROM customer
"""

RAW_ESTABLISHMENTS = f"""
SELECT
  CAST(o.o_custkey AS VARCHAR) AS cnpj_basico,
  lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0') AS cnpj_ordem,
  lpad(CAST(o_orderkey % 97 AS VARCHAR), 2, '0') AS cnpj_dv,
  CASE WHEN o_orderpriority = '1-URGENT' THEN '1' ELSE '2' END AS identificador_matriz_filial,
  o_orderpriority AS nome_fantasia,
  {case_map('o_orderstatus', SITUATION_BY_STATUS)} AS situacao_cadastral,
  CASE WHEN o_orderkey % 13 = 0 THEN '00000000' ELSE strftime(o_orderdate, '%Y%m%d') END AS data_situacao_cadastral,
  CASE WHEN o_orderkey % 11 = 0 THEN ' ' || strftime(o_orderdate, '%Y/%m/%d') || ' '
       WHEN o_orderkey % 17 = 0 THEN '0' WHEN o_orderkey % 19 = 0 THEN '20231345'
       ELSE strftime(o_orderdate, '%Y%m%d') END AS data_inicio_atividade,
  lpad(CAST(o.o_custkey % 9999999 AS VARCHAR), 7, '0') AS cnae_fiscal_principal,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL
       ELSE CAST(o_orderkey % 1000 AS VARCHAR) || ',A' || CAST(o.o_custkey AS VARCHAR) || ' ;x,' || CAST(o_orderkey % 7 AS VARCHAR)
       END AS cnae_fiscal_secundaria,
  CASE WHEN o_orderkey % 2 = 0 THEN 'SP' ELSE 'RJ' END AS uf,
  CAST(o.o_custkey % 5000 AS VARCHAR) AS municipio,
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE strftime(o_orderdate, '%Y%m%d') END AS data_situacao_especial
FROM orders o
"""

RAW_PARTNERS = """
SELECT
  CAST(l_suppkey AS VARCHAR) AS cnpj_basico,
  CAST(l_linenumber % 3 + 1 AS VARCHAR) AS identificador_socio,
  '  Socio ' || CAST(l_partkey AS VARCHAR) AS nome_socio_razao_social,
  lpad(CAST(l_partkey AS VARCHAR), 11, '*') AS cnpj_cpf_socio,
  CAST(l_linenumber + 10 AS VARCHAR) AS qualificacao_socio,
  CASE WHEN l_orderkey % 9 = 0 THEN '00/00/0000' ELSE strftime(l_shipdate, '%Y%m%d') END AS data_entrada_sociedade,
  CAST(l_linenumber AS VARCHAR) AS faixa_etaria
FROM lineitem
"""

RAW_SIMPLES = """
SELECT
  CAST(c_custkey AS VARCHAR) AS cnpj_basico,
  CASE WHEN c_custkey % 47 = 0 THEN 'X' WHEN c_custkey % 23 = 0 THEN ' '
       WHEN c_custkey % 2 = 0 THEN 'S' ELSE 'N' END AS opcao_pelo_simples,
  CASE WHEN c_custkey % 2 = 0 THEN '2007' || lpad(CAST(c_custkey % 12 + 1 AS VARCHAR), 2, '0') || '01'
       ELSE '00000000' END AS data_opcao_simples,
  CASE WHEN c_custkey % 3 = 0 THEN '20231345' ELSE '0' END AS data_exclusao_simples,
  CASE WHEN c_custkey % 7 = 0 THEN 'S' ELSE 'N' END AS opcao_mei,
  CASE WHEN c_custkey % 7 = 0 THEN '20090701' ELSE '' END AS data_opcao_mei,
  '00000000' AS data_exclusao_mei
FROM customer WHERE c_acctbal >= 0
"""

NATUREZAS = """
SELECT CAST(n_nationkey + 2000 AS VARCHAR) AS codigo, n_name AS descricao, n_regionkey FROM nation
"""


def file_name_sql(k: str) -> str:
    n = f"(CASE WHEN {k} % 53 = 0 THEN {k} ELSE {k} % 500 END)"
    return (f"{pick(n, FILE_PREFIXES)} || CAST({n} AS VARCHAR) || "
            f"CASE WHEN {n} % 10 = 9 THEN '.ZIP' ELSE '.zip' END")


def year_month_sql(k: str) -> str:
    return (f"CASE WHEN {k} % 53 = 0 THEN 'BASE' "
            f"ELSE strftime(DATE '1992-01-01' + to_months(CAST({k} // 500 AS INTEGER)), '%Y-%m') END")


CONTROL = f"""
SELECT file_id, year_month, file_name, file_size_bytes, etag,
  CASE WHEN status IN ('pending', 'downloading') OR file_id % 17 = 0 THEN NULL
       ELSE sha256(CAST(file_id AS VARCHAR)) END AS local_hash,
  CASE WHEN status = 'pending' THEN NULL
       WHEN status = 'downloading' THEN file_size_bytes - file_id % 1000
       WHEN file_id % 23 = 0 THEN file_size_bytes + 5 ELSE file_size_bytes END AS local_size_bytes,
  CASE WHEN status = 'pending' THEN 0.0::DOUBLE
       WHEN status = 'downloading' THEN CAST(file_id % 100 AS DOUBLE)
       WHEN status = 'error' THEN 0.0::DOUBLE ELSE 100.0::DOUBLE END AS download_progress,
  discovered_at,
  CASE WHEN status NOT IN ('pending', 'downloading') AND status <> 'error'
       THEN discovered_at + INTERVAL 1 DAY END AS synced_at,
  status,
  CASE WHEN status = 'error' THEN 'download failed: ' || file_name END AS error_message, priority, order_status
FROM (
  SELECT o_orderkey AS file_id,
    {year_month_sql('o_orderkey')} AS year_month,
    {file_name_sql('o_orderkey')} AS file_name,
    CASE WHEN o_orderkey % 19 = 0 THEN NULL
         ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2)) * 100 AS BIGINT) END AS file_size_bytes,
    md5(CAST(o_custkey AS VARCHAR)) AS etag,
    {pick('o_orderkey', STATUS_BY_MOD)} AS status,
    o_orderdate AS discovered_at, o_orderpriority AS priority, o_orderstatus AS order_status
  FROM orders) b
"""

REMOTE_LISTING = f"""
SELECT {year_month_sql('o_orderkey')} AS year_month,
  {file_name_sql('o_orderkey')} AS file_name,
  CAST(CAST(o_totalprice AS DECIMAL(15,2)) * 100 AS BIGINT) AS size,
  CASE WHEN o_orderkey % 31 = 0 THEN md5(CAST(o_custkey + 1 AS VARCHAR))
       ELSE md5(CAST(o_custkey AS VARCHAR)) END AS etag
FROM orders
"""

KNOWN_CONTROL = f"""
SELECT * FROM ({CONTROL}) c
WHERE (year_month = 'BASE' OR year_month < '{KNOWN_BEFORE}') AND priority <> '5-LOW'
"""

STORE = f"""
SELECT 'raw/' || year_month || '/' || file_name AS key,
  coalesce(local_size_bytes, file_size_bytes, 0) + CASE WHEN file_id % 13 = 0 THEN 1 ELSE 0 END AS size_bytes,
  discovered_at + INTERVAL 2 DAY AS last_modified,
  md5(CAST(file_id AS VARCHAR)) AS etag,
  CASE WHEN order_status = 'P' THEN NULL
       WHEN file_id % 29 = 0 THEN sha256(CAST(file_id + 1 AS VARCHAR)) ELSE sha256(CAST(file_id AS VARCHAR)) END AS content_hash
FROM ({CONTROL}) c WHERE year_month <> '{STORE_MISSING_MONTH}'
  AND (status NOT IN ('pending', 'downloading') AND priority <> '5-LOW' OR status = 'downloading' AND priority = '1-URGENT')
UNION ALL
SELECT 'processed/' || year_month || '/' || replace(file_name, '.zip', '.parquet'),
  coalesce(file_size_bytes, 0) // 4, discovered_at + INTERVAL 3 DAY, md5(CAST(file_id + 7 AS VARCHAR)), NULL
FROM ({CONTROL}) c WHERE status IN ('transformed', 'loaded') AND priority <> '4-NOT SPECIFIED'
  AND year_month <> '{STORE_MISSING_MONTH}'
UNION ALL
SELECT 'raw/' || strftime(CAST(discovered_at AS DATE) + INTERVAL 240 MONTH, '%Y-%m') || '/orphan' || CAST(file_id AS VARCHAR) || '.zip',
  file_id * 10, discovered_at, md5(CAST(file_id AS VARCHAR)), NULL
FROM ({CONTROL}) c WHERE order_status = 'P'
UNION ALL
SELECT year_month || '/' || file_name, file_id * 3, discovered_at, md5(CAST(file_id AS VARCHAR)), NULL
FROM ({CONTROL}) c WHERE year_month NOT IN ('BASE', '{STORE_MISSING_MONTH}') AND priority = '2-HIGH' AND order_status = 'F'
UNION ALL
SELECT 'readme' || CAST(file_id AS VARCHAR) || '.txt', file_id, discovered_at, md5(CAST(file_id AS VARCHAR)), NULL
FROM ({CONTROL}) c WHERE year_month = 'BASE' AND priority = '3-MEDIUM'
"""

PROCESSED_STATS = f"""
SELECT {year_month_sql('l_orderkey')} AS year_month, replace({file_name_sql('l_orderkey')}, '.zip', '.parquet') AS parquet_file,
  count(*) AS row_count, CAST(sum(l_linenumber * 1000 + 4096) AS BIGINT) AS size_bytes
FROM lineitem GROUP BY l_orderkey HAVING bool_or(l_returnflag = 'R')
"""

CONTROL_EVENTS = """
SELECT 'File' || CAST(user_id AS VARCHAR) || '.zip' AS file_name, event_type AS status,
  ts AS event_time, event_id AS seq, value
FROM events
"""


def companies_sql() -> str:
    """Silver companies: NA tokens -> null, then the Empresas rules."""
    cols = {
        "cnpj_basico": zfill(na("cnpj_basico")),
        "razao_social": strip(na("razao_social")),
        "natureza_juridica": na("natureza_juridica"),
        "qualificacao_responsavel": na("qualificacao_responsavel"),
        "capital_social": decimal_comma(na("capital_social")),
        "porte_empresa": na("porte_empresa"),
        "ente_federativo_responsavel": na("ente_federativo_responsavel"),
    }
    return "SELECT " + ", ".join(f"{v} AS {k}" for k, v in cols.items()) + f" FROM ({RAW_COMPANIES}) r"


def simples_sql() -> str:
    cols = {
        "cnpj_basico": zfill(na("cnpj_basico")),
        "opcao_pelo_simples": na("opcao_pelo_simples"),
        "data_opcao_simples": date_text(na("data_opcao_simples")),
        "data_exclusao_simples": date_text(na("data_exclusao_simples")),
        "opcao_mei": na("opcao_mei"),
        "data_opcao_mei": date_text(na("data_opcao_mei")),
        "data_exclusao_mei": date_text(na("data_exclusao_mei")),
    }
    return "SELECT " + ", ".join(f"{v} AS {k}" for k, v in cols.items()) + f" FROM ({RAW_SIMPLES}) r"


def establishments_sql() -> str:
    plain = ["cnpj_ordem", "cnpj_dv", "identificador_matriz_filial", "nome_fantasia", "situacao_cadastral",
             "cnae_fiscal_principal", "uf", "municipio"]
    cols = {"cnpj_basico": zfill(na("cnpj_basico"))}
    cols.update({c: na(c) for c in plain})
    cols["cnae_fiscal_secundaria"] = digits_commas(na("cnae_fiscal_secundaria"))
    for d in ("data_situacao_cadastral", "data_inicio_atividade", "data_situacao_especial"):
        cols[d] = date_text(na(d))
    return "SELECT " + ", ".join(f"{v} AS {k}" for k, v in cols.items()) + f" FROM ({RAW_ESTABLISHMENTS}) r"


def partners_sql() -> str:
    plain = ["identificador_socio", "nome_socio_razao_social", "cnpj_cpf_socio", "qualificacao_socio", "faixa_etaria"]
    cols = {"cnpj_basico": zfill(na("cnpj_basico"))}
    cols.update({c: na(c) for c in plain})
    cols["data_entrada_sociedade"] = date_text(na("data_entrada_sociedade"))
    return "SELECT " + ", ".join(f"{v} AS {k}" for k, v in cols.items()) + f" FROM ({RAW_PARTNERS}) r"
