"""Entity cleaning rules (bronze text -> silver).

Rules are column expressions applied with one ``withColumns`` per entity, so
the whole transform is a single narrow stage after the scan.  A rule is only
applied when its column is present, which lets partial layouts through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiflow.functions.dates import normalize_date_text
from regiflow.functions.numbers import decimal_comma
from regiflow.functions.text import digits_and_commas, null_na_tokens, strip_unicode, zfill
from regiflow.schema import DATE_COLUMNS, LAYOUTS


def _key(c: str) -> Column:
    return zfill(F.col(c))


# entity -> {column: rule}
RULES: dict[str, dict[str, Callable[[str], Column]]] = {
    "Empresas": {
        "cnpj_basico": _key,
        "razao_social": lambda c: strip_unicode(F.col(c)),
        "capital_social": lambda c: decimal_comma(F.col(c)),
    },
    "Estabelecimentos": {
        "cnpj_basico": _key,
        "cnae_fiscal_secundaria": lambda c: digits_and_commas(F.col(c)),
        **{d: (lambda c: normalize_date_text(F.col(c))) for d in DATE_COLUMNS["Estabelecimentos"]},
    },
    "Socios": {
        "cnpj_basico": _key,
        **{d: (lambda c: normalize_date_text(F.col(c))) for d in DATE_COLUMNS["Socios"]},
    },
    "Simples": {
        "cnpj_basico": _key,
        **{d: (lambda c: normalize_date_text(F.col(c))) for d in DATE_COLUMNS["Simples"]},
    },
}


def clean_na(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Turn NA tokens into nulls for every string column (CSV read semantics)."""
    cols = columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.withColumns({c: null_na_tokens(c) for c in cols})


def apply_rules(df: DataFrame, entity: str) -> DataFrame:
    """Apply the cleaning rules of ``entity``; lookups pass through unchanged."""
    rules = RULES.get(entity, {})
    present = {c: rule(c) for c, rule in rules.items() if c in df.columns}
    return df.withColumns(present) if present else df


def normalize(df: DataFrame, entity: str) -> DataFrame:
    """NA tokens -> null, then entity rules: raw text frame -> silver frame."""
    return apply_rules(clean_na(df), entity)


def is_mapped_entity(entity: str) -> bool:
    return entity in LAYOUTS
