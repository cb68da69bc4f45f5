"""Layouts, typed schemas and fixed value lists of the company registry.

Raw registry files are headerless, ``;``-separated, ISO-8859-1 text where every
field is a string and the column meaning is given by position only.  The
layouts below name those positions ("bronze").  ``TYPED`` gives the warehouse
types ("gold"); silver keeps strings/doubles as produced by the entity rules.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the published registry layout and the
# reference behaviour for results to match.  Natural (file) order.
# ---------------------------------------------------------------------------

LAYOUTS: dict[str, list[str]] = {
    "Empresas": [
        "cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_responsavel",
        "capital_social", "porte_empresa", "ente_federativo_responsavel",
    ],
    "Estabelecimentos": [
        "cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial",
        "nome_fantasia", "situacao_cadastral", "data_situacao_cadastral",
        "motivo_situacao_cadastral", "nome_cidade_exterior", "pais",
        "data_inicio_atividade", "cnae_fiscal_principal", "cnae_fiscal_secundaria",
        "tipo_logradouro", "logradouro", "numero", "complemento", "bairro", "cep", "uf",
        "municipio", "ddd_1", "telefone_1", "ddd_2", "telefone_2", "ddd_fax", "fax",
        "correio_eletronico", "situacao_especial", "data_situacao_especial",
    ],
    "Socios": [
        "cnpj_basico", "identificador_socio", "nome_socio_razao_social", "cnpj_cpf_socio",
        "qualificacao_socio", "data_entrada_sociedade", "pais", "representante_legal",
        "nome_representante", "qualificacao_representante_legal", "faixa_etaria",
    ],
    "Simples": [
        "cnpj_basico", "opcao_pelo_simples", "data_opcao_simples", "data_exclusao_simples",
        "opcao_mei", "data_opcao_mei", "data_exclusao_mei",
    ],
    "Paises": ["codigo", "descricao"],
    "Municipios": ["codigo", "descricao"],
    "Qualificacoes": ["codigo", "descricao"],
    "Naturezas": ["codigo", "descricao"],
    "Cnaes": ["codigo", "descricao"],
    "Motivos": ["codigo", "descricao"],
}

# Entity -> warehouse table (prefix match on the lower-cased file base name).
TABLES: dict[str, str] = {
    "empresas": "cnpj_empresas",
    "estabelecimentos": "cnpj_estabelecimentos",
    "socios": "cnpj_socios",
    "simples": "cnpj_simples",
    "paises": "cnpj_paises",
    "municipios": "cnpj_municipios",
    "qualificacoes": "cnpj_qualificacoes",
    "naturezas": "cnpj_naturezas",
    "cnaes": "cnpj_cnaes",
    "motivos": "cnpj_motivos",
}

# Date columns normalised per entity.
DATE_COLUMNS: dict[str, list[str]] = {
    "Estabelecimentos": ["data_situacao_cadastral", "data_inicio_atividade", "data_situacao_especial"],
    "Socios": ["data_entrada_sociedade"],
    "Simples": ["data_opcao_simples", "data_exclusao_simples", "data_opcao_mei", "data_exclusao_mei"],
}

# Text read as null by the CSV step: pandas' default NA strings plus "" and "NA".
NA_TOKENS: list[str] = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Date text that means "no date" (compared after stripping whitespace).
DATE_NULL_TOKENS: list[str] = ["", "None", "nan", "0", "00000000", "00/00/0000"]

# File life-cycle states of the control table.
STATUSES: list[str] = [
    "pending", "downloading", "downloaded", "transforming", "transformed", "loaded", "error",
]

# Status sets used by the planners and reports.
DOWNLOADED_OR_LATER = ["downloaded", "transformed", "loaded"]
TRANSFORMED_OR_LATER = ["transformed", "loaded"]

# Allowed values of the Simples option flag (data-quality rule).
SIMPLES_OPTION_VALUES = ["S", "N", " ", ""]

# Company size codes used as the classification target.
SIZE_CLASSES = ["01", "03", "05"]

# Text shown for an ETA that cannot be estimated.
ETA_PLACEHOLDER = "calculando..."

MEMORY_EXPANSION = 7
PARQUET_FRACTION = 0.25
PAGE_LIMIT_DEFAULT = 20
PAGE_LIMIT_MAX = 100
SEARCH_MIN_CHARS = 3
LIST_MAX_KEYS = 1000
ERROR_MESSAGE_CHARS = 1000
KEY_WIDTH = 8

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------


def raw_schema(entity: str) -> T.StructType:
    """All-string positional schema of a raw entity file."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in LAYOUTS[entity]])


_S, _I, _D = T.StringType(), T.IntegerType(), T.DateType()
_N = T.DecimalType(15, 2)

# Warehouse types and bounded string lengths: (type, max_length or None).
TYPED: dict[str, dict[str, tuple[T.DataType, int | None]]] = {
    "Empresas": {
        "cnpj_basico": (_S, 8), "razao_social": (_S, 255), "natureza_juridica": (_S, 4),
        "qualificacao_responsavel": (_S, 2), "capital_social": (_N, None),
        "porte_empresa": (_S, 2), "ente_federativo_responsavel": (_S, 255),
    },
    "Estabelecimentos": {
        "cnpj_basico": (_S, 8), "cnpj_ordem": (_S, 4), "cnpj_dv": (_S, 2),
        "identificador_matriz_filial": (_I, None), "nome_fantasia": (_S, 255),
        "situacao_cadastral": (_I, None), "data_situacao_cadastral": (_D, None),
        "motivo_situacao_cadastral": (_I, None), "nome_cidade_exterior": (_S, 255),
        "pais": (_I, None), "data_inicio_atividade": (_D, None),
        "cnae_fiscal_principal": (_S, 7), "cnae_fiscal_secundaria": (_S, 1000),
        "tipo_logradouro": (_S, 50), "logradouro": (_S, 255), "numero": (_S, 50),
        "complemento": (_S, 255), "bairro": (_S, 255), "cep": (_S, 8), "uf": (_S, 2),
        "municipio": (_I, None), "ddd_1": (_S, 4), "telefone_1": (_S, 8), "ddd_2": (_S, 4),
        "telefone_2": (_S, 8), "ddd_fax": (_S, 4), "fax": (_S, 8),
        "correio_eletronico": (_S, 255), "situacao_especial": (_S, 255),
        "data_situacao_especial": (_D, None),
    },
    "Socios": {
        "cnpj_basico": (_S, 8), "identificador_socio": (_I, None),
        "nome_socio_razao_social": (_S, 255), "cnpj_cpf_socio": (_S, 14),
        "qualificacao_socio": (_I, None), "data_entrada_sociedade": (_D, None), "pais": (_I, None),
        "representante_legal": (_S, 11), "nome_representante": (_S, 255),
        "qualificacao_representante_legal": (_I, None), "faixa_etaria": (_I, None),
    },
    "Simples": {
        "cnpj_basico": (_S, 8), "opcao_pelo_simples": (_S, 1), "data_opcao_simples": (_D, None),
        "data_exclusao_simples": (_D, None), "opcao_mei": (_S, 1), "data_opcao_mei": (_D, None),
        "data_exclusao_mei": (_D, None),
    },
    "Paises": {"codigo": (_I, None), "descricao": (_S, 255)},
    "Municipios": {"codigo": (_I, None), "descricao": (_S, 255)},
    "Qualificacoes": {"codigo": (_I, None), "descricao": (_S, 255)},
    "Naturezas": {"codigo": (_I, None), "descricao": (_S, 255)},
    "Cnaes": {"codigo": (_S, 7), "descricao": (_S, 255)},
    "Motivos": {"codigo": (_I, None), "descricao": (_S, 255)},
}


def typed_schema(entity: str) -> T.StructType:
    return T.StructType([T.StructField(c, t, True) for c, (t, _) in TYPED[entity].items()])


CONTROL_SCHEMA = T.StructType([
    T.StructField("year_month", T.StringType(), False),
    T.StructField("file_name", T.StringType(), False),
    T.StructField("file_size_bytes", T.LongType(), True),
    T.StructField("etag", T.StringType(), True),
    T.StructField("local_hash", T.StringType(), True),
    T.StructField("local_size_bytes", T.LongType(), True),
    T.StructField("download_progress", T.DoubleType(), True),
    T.StructField("discovered_at", T.TimestampType(), True),
    T.StructField("synced_at", T.TimestampType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("error_message", T.StringType(), True),
])

# Event log form of the control table: one row per state change.
CONTROL_EVENT_SCHEMA = T.StructType(
    list(CONTROL_SCHEMA.fields)
    + [T.StructField("event_time", T.TimestampType(), False), T.StructField("seq", T.LongType(), False)]
)
