"""Whole registry records of all ten entities, as text lines in numbered parts.

``standins`` builds the columns that the rules look at; here every column of the published
layouts is there, and records travel as raw lines: written by the line codec, some made
too long or too short, dealt to parts by key.  The extra columns are expressions that Spark
and DuckDB both read, so the oracle builds the same records.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiflow.plans import oracle as O
from regiflow.plans import standins as S
from regiflow.schema import DATE_COLUMNS, LAYOUTS
from regiflow.session import checkpoint_dir
from regiflow.sources.lines import parse_lines, to_lines
from regiflow.sources.tables import table

PARTS = 10
MAIN = ("Empresas", "Estabelecimentos", "Socios", "Simples")
LOOKUPS = tuple(e for e in LAYOUTS if e not in MAIN)

# Stand-in values of the columns that ``standins`` leaves out
_EXTRA = {
    "Estabelecimentos": {
        "nome_fantasia": "CASE WHEN o_orderkey % 4 = 0 THEN concat('LOJA \"', CAST(o_custkey AS STRING), '\"; FILIAL') "
                         "WHEN o_orderkey % 6 = 1 THEN 'null' ELSE o_orderpriority END",
        "motivo_situacao_cadastral": "CAST(o_orderkey % 80 AS STRING)",
        "nome_cidade_exterior": "CASE WHEN o_orderkey % 8 = 0 THEN 'SÃO JOÃO' ELSE '' END",
        "pais": "CASE WHEN o_orderkey % 8 = 0 THEN CAST(o_orderkey % 25 + 100 AS STRING) ELSE '' END",
        "tipo_logradouro": "CASE WHEN o_orderkey % 3 = 0 THEN 'RUA' WHEN o_orderkey % 3 = 1 THEN 'AVENIDA' ELSE 'PRAÇA' END",
        "logradouro": "concat('DAS ACÁCIAS ', CAST(o_custkey % 300 AS STRING))",
        "numero": "CASE WHEN o_orderkey % 10 = 0 THEN 'S/N' ELSE CAST(o_orderkey % 2000 AS STRING) END",
        "complemento": "CASE WHEN o_orderkey % 9 = 0 THEN concat('SALA ', CAST(o_orderkey % 40 AS STRING), ' ;BLOCO B') ELSE '' END",
        "bairro": "'CENTRO'",
        "cep": "lpad(CAST(o_custkey * 7 % 99999999 AS STRING), 8, '0')",
        "ddd_1": "CAST(o_orderkey % 89 + 11 AS STRING)",
        "telefone_1": "lpad(CAST(o_orderkey % 99999999 AS STRING), 8, '3')",
        "ddd_2": "CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey % 89 + 11 AS STRING) ELSE '' END",
        "telefone_2": "CASE WHEN o_orderkey % 5 = 0 THEN '99990000' ELSE '' END",
        "ddd_fax": "''", "fax": "''",
        "correio_eletronico": "CASE WHEN o_orderkey % 2 = 0 THEN concat('loja', CAST(o_custkey AS STRING), '@exemplo.com.br') ELSE '' END",
        "situacao_especial": "CASE WHEN o_orderkey % 50 = 0 THEN 'FALIDO' ELSE '' END",
    },
    "Socios": {
        "pais": "CASE WHEN l_linenumber = 7 THEN '105' ELSE '' END",
        "representante_legal": "CASE WHEN l_linenumber % 3 = 0 THEN '***000000**' ELSE '' END",
        "nome_representante": "CASE WHEN l_linenumber % 3 = 0 THEN concat('JOSÉ \"ZÉ\" ', CAST(l_suppkey AS STRING)) ELSE '' END",
        "qualificacao_representante_legal": "CAST(l_linenumber % 3 * 5 AS STRING)",
    },
    "Empresas": {}, "Simples": {},
}
# What tells the records of an entity apart, and the table it comes from
_KEY = {"Empresas": "c_custkey", "Estabelecimentos": "o_orderkey", "Socios": "l_orderkey * 10 + l_linenumber", "Simples": "c_custkey"}
_RAW = {"Empresas": (S.raw_companies, O.RAW_COMPANIES), "Estabelecimentos": (S.raw_establishments, O.RAW_ESTABLISHMENTS),
        "Socios": (S.raw_partners, O.RAW_PARTNERS), "Simples": (S.raw_simples, O.RAW_SIMPLES)}
# Code tables: key, code and description by table
_LOOKUP = {
    "Paises": ("nation", "n_nationkey", "CAST(n_nationkey + 100 AS STRING)", "n_name"),
    "Municipios": ("supplier", "s_suppkey", "lpad(CAST(s_suppkey AS STRING), 4, '0')", "concat('CIDADE; ', s_name)"),
    "Qualificacoes": ("region", "r_regionkey", "lpad(CAST(r_regionkey AS STRING), 2, '0')", "r_name"),
    "Naturezas": ("nation", "n_nationkey", "CAST(n_nationkey + 2000 AS STRING)", "concat('\"', n_name, '\"')"),
    "Cnaes": ("part", "p_partkey", "lpad(CAST(p_partkey AS STRING), 7, '0')", "p_name"),
    "Motivos": ("supplier", "s_suppkey", "CAST(s_suppkey % 100 AS STRING)", "CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE s_name END"),
}


def records(spark: SparkSession, sf: str, entity: str) -> DataFrame:
    """All columns of the entity's layout as raw text, and ``_k``."""
    if entity in LOOKUPS:
        name, key, code, text = _LOOKUP[entity]
        return table(spark, sf, name).select(F.expr(code).alias("codigo"), F.expr(text).alias("descricao"), F.expr(key).cast("long").alias("_k"))
    extra = {c: F.expr(e).alias(f"_{c}") for c, e in _EXTRA[entity].items()}
    df = _RAW[entity][0](spark, sf, *extra.values(), F.expr(_KEY[entity]).cast("long").alias("_k"))
    return df.select(*[F.col(f"_{c}" if c in extra else c).alias(c) for c in LAYOUTS[entity]], "_k")


def _damaged(line: Column, fields: int) -> Column:
    """Some records one field too long, some too short."""
    k = F.col("_k")
    return F.when(k % 67 == 0, F.concat(line, F.lit(";sobra"))).when(k % 71 == 0, F.substring_index(line, ";", min(2, fields - 1))).otherwise(line)


def part_lines(spark: SparkSession, sf: str, entity: str, extension: str = "csv", damage: bool = True) -> DataFrame:
    """(source_file, line): the entity's records as lines of numbered parts."""
    lines = to_lines(records(spark, sf, entity), entity, keep=("_k",))
    part = F.concat(F.lit(entity), F.pmod("_k", F.lit(PARTS)), F.lit(f".{extension}"))
    return lines.select(part.alias("source_file"), (_damaged(F.col("line"), len(LAYOUTS[entity])) if damage else F.col("line")).alias("line"))


def parsed(spark: SparkSession, sf: str, entity: str) -> DataFrame:
    """The lines read back, with ``_corrupt_record`` and ``source_file``."""
    return parse_lines(part_lines(spark, sf, entity), entity, keep=("source_file",))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for derived files below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- the same in DuckDB SQL

def raw_sql(entity: str) -> str:
    if entity in LOOKUPS:
        name, key, code, text = _LOOKUP[entity]
        return f"SELECT {code} AS codigo, {text} AS descricao, CAST({key} AS BIGINT) AS _k FROM {name}"
    extra = _EXTRA[entity]
    head, _, tail = _RAW[entity][1].rpartition("FROM ")
    more = "".join(f", {e} AS _{c}" for c, e in extra.items())
    inner = f"{head.rstrip()}{more}, CAST({_KEY[entity]} AS BIGINT) AS _k FROM {tail}"
    return "SELECT " + ", ".join(f"{'_' + c if c in extra else c} AS {c}" for c in LAYOUTS[entity]) + f", _k FROM ({inner}) i"


def part_sql(entity: str, extension: str = "csv") -> str:
    return f"'{entity}' || (_k % {PARTS}) || '.{extension}'"


GOOD = "_k % 67 <> 0 AND _k % 71 <> 0"


def normalized_sql(entity: str, where: str = GOOD, extension: str = "csv") -> str:
    """Cleaned records that are not damaged, with their part."""
    rule = {c: O.date_text for c in DATE_COLUMNS.get(entity, ())}
    if entity in MAIN:
        rule["cnpj_basico"] = O.zfill
    rule |= {"Empresas": {"razao_social": O.strip, "capital_social": O.decimal_comma},
             "Estabelecimentos": {"cnae_fiscal_secundaria": O.digits_commas}}.get(entity, {})
    clean = ", ".join(f"{O.na(c)} AS {c}" for c in LAYOUTS[entity])
    cols = ", ".join(f"{rule.get(c, str)(c)} AS {c}" for c in LAYOUTS[entity])
    return f"SELECT {cols}, source_file FROM (SELECT {clean}, {part_sql(entity, extension)} AS source_file FROM ({raw_sql(entity)}) r WHERE {where}) c"


def quarantine_sql(entity: str) -> str:
    field = lambda c: (f"CASE WHEN contains({c}, ';') OR contains({c}, '\"') THEN '\"' || replace({c}, '\"', '\"\"') || '\"' "  # noqa: E731
                       f"ELSE coalesce({c}, '') END")
    line = " || ';' || ".join(field(c) for c in LAYOUTS[entity])
    n = min(2, len(LAYOUTS[entity]) - 1)
    short = f"array_to_string(string_split(line, ';')[1:{n}], ';')"
    return (f"SELECT '{entity}' AS entity, {part_sql(entity)} AS source_file, CASE WHEN _k % 67 = 0 THEN line || ';sobra' ELSE {short} END AS line "
            f"FROM (SELECT _k, {line} AS line FROM ({raw_sql(entity)}) r WHERE NOT ({GOOD})) d")
