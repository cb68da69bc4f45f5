"""Registry queries: paging, name search, key lookup, code enrichment.

All results are ordered by key and, where keys repeat or are missing, by the other
columns, so pages are deterministic.  Top-N
with offset plans as ``TakeOrderedAndProject`` (each task keeps only
offset+limit rows); deep pages should use ``after`` (keyset paging), which
turns into a pushed-down range filter instead of a larger top-N.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiflow.schema import PAGE_LIMIT_DEFAULT, PAGE_LIMIT_MAX, SEARCH_MIN_CHARS

LIST_COLUMNS = ["cnpj_basico", "razao_social", "natureza_juridica", "capital_social", "porte_empresa"]
DETAIL_COLUMNS = ["cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_responsavel",
                  "capital_social", "porte_empresa", "ente_federativo_responsavel"]


def check_page(limit: int, offset: int = 0) -> None:
    if not 1 <= limit <= PAGE_LIMIT_MAX:
        raise ValueError(f"limit must be within 1..{PAGE_LIMIT_MAX}")
    if offset < 0:
        raise ValueError("offset must be >= 0")


def total(companies: DataFrame) -> DataFrame:
    """One-row total count (``count`` pushes down to Parquet footers when possible)."""
    return companies.agg(F.count(F.lit(1)).alias("total"))


def _after(last: dict, columns: list[str]) -> Column:
    """Rows that equal ``last`` or follow it in ascending order, nulls last."""
    cond = F.lit(True)
    for c in reversed(columns):
        v = F.lit(last[c])
        later = F.lit(False) if last[c] is None else F.coalesce(F.col(c) > v, F.lit(True))
        cond = later | (F.col(c).eqNullSafe(v) & cond)
    return cond


def list_page(companies: DataFrame, limit: int = PAGE_LIMIT_DEFAULT, offset: int = 0,
              after_key: str | None = None, key: str = "cnpj_basico",
              after: dict | None = None, ties: int = 0) -> DataFrame:
    """One page of companies in key order; rows of one key are ordered by their other columns.

    ``after_key`` starts behind a key.  ``after`` (a row as a dict) with ``ties`` (how many rows
    equal to it were given so far) continues behind that row, so paging reaches every row, also
    null and repeated keys and repeated rows.
    """
    check_page(limit, offset)
    columns = [key, *[c for c in LIST_COLUMNS if c != key]]
    df = companies.select(*LIST_COLUMNS)
    if after_key is not None:
        df = df.where(F.col(key) > F.lit(after_key))
    if after is not None:
        df, offset = df.where(_after(after, columns)), offset + ties
    page = df.orderBy(*[F.col(c).asc_nulls_last() for c in columns])
    if offset:
        page = page.offset(offset)
    return page.limit(limit)


def _escape_like(term: str, esc: str = "\\") -> str:
    return term.replace(esc, esc + esc).replace("%", esc + "%").replace("_", esc + "_")


def search_pattern(term: str, escape: bool = False) -> str:
    """The LIKE pattern of a search; ``escape`` takes ``%`` and ``_`` literally."""
    if term is None or len(term) < SEARCH_MIN_CHARS:
        raise ValueError(f"search term needs at least {SEARCH_MIN_CHARS} characters")
    return f"%{_escape_like(term) if escape else term}%"


def search_name(companies: DataFrame, term: str, limit: int = PAGE_LIMIT_DEFAULT,
                escape: bool = False, key: str = "cnpj_basico") -> DataFrame:
    """Case-insensitive substring search on the company name.

    As in the reference, ``%`` and ``_`` in the term act as wildcards unless
    ``escape=True``.
    """
    pattern = search_pattern(term, escape)
    check_page(limit)
    hits = companies.where(F.col("razao_social").ilike(pattern))
    return hits.select(*LIST_COLUMNS).orderBy(F.col(key).asc_nulls_last()).limit(limit)


def search_all(companies: DataFrame, term: str, escape: bool = False) -> DataFrame:
    """Every match of the search (no page cap), for reports and export."""
    return companies.where(F.col("razao_social").ilike(search_pattern(term, escape))).select(*LIST_COLUMNS)


def lookup_key(companies: DataFrame, cnpj_basico: str, key: str = "cnpj_basico") -> DataFrame:
    """The first company with this key (0 rows = not found)."""
    return companies.where(F.col(key) == F.lit(cnpj_basico)).select(*DETAIL_COLUMNS).limit(1)


def lookup_keys(companies: DataFrame, keys: DataFrame, key: str = "cnpj_basico") -> DataFrame:
    """Batch lookup: every company whose key appears in ``keys`` (semi join)."""
    return companies.join(keys.select(key).distinct(), key, "left_semi").select(*DETAIL_COLUMNS)


def enrich_codes(companies: DataFrame, naturezas: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """Attach code descriptions from lookup tables (left joins).

    Code tables are small; Spark's size estimates and adaptive execution choose
    the broadcast, and a shuffle join where a table is not small after all.
    """
    nat = naturezas.select(F.col("codigo").alias("natureza_juridica"),
                           F.col("descricao").alias("natureza_descricao"), *(
                               ["n_regionkey"] if "n_regionkey" in naturezas.columns else []))
    out = companies.join(nat, "natureza_juridica", "left")
    if regions is not None and "n_regionkey" in nat.columns:
        out = out.join(regions, "n_regionkey", "left").drop("n_regionkey")
    return out
