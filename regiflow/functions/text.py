"""String column functions (keys, names, codes, file names, object keys).

Every function takes and returns ``Column`` objects built from
``pyspark.sql.functions``, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from regiflow.schema import KEY_WIDTH, LAYOUTS, NA_TOKENS, TABLES

# Fixed value: the characters Python's ``str.strip()`` treats as whitespace
# (``str.isspace``), as a regex class usable by both Java regex and RE2.
WHITESPACE_CLASS = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_STRIP_PATTERN = f"^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sql_text(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


_NA_TOKENS_SQL = ", ".join(_sql_text(t) for t in NA_TOKENS)


def null_na_tokens(c) -> Column:
    """Raw CSV text -> null when it is one of the NA tokens (exact match).

    Given a column name, the test is parsed from one SQL expression (the same
    ``InSet`` Catalyst builds from ``isin``, in one JVM call instead of one per
    token); this runs for every string column of every raw frame.
    """
    if isinstance(c, str):
        q = "`" + c.replace("`", "``") + "`"
        return F.expr(f"CASE WHEN {q} IN ({_NA_TOKENS_SQL}) THEN NULL ELSE {q} END")
    return F.when(c.isin(NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def strip_unicode(c) -> Column:
    """Remove leading/trailing Unicode whitespace (NBSP, TAB, U+0085 ...).

    ``F.trim`` only removes the space character, so a name padded with NBSP or
    TAB would keep it.
    """
    return F.regexp_replace(_c(c), _STRIP_PATTERN, "")


def zfill(c, width: int = KEY_WIDTH) -> Column:
    """Left-pad with zeros to ``width`` without ever truncating; sign-aware.

    ``lpad`` alone cuts longer values ("123456789" -> "12345678") and puts
    zeros before a sign ("-5" -> "000000-5").
    """
    c = _c(c)
    signed = c.startswith("-") | c.startswith("+")
    return (
        F.when(F.length(c) >= width, c)
        .when(signed, F.concat(F.substring(c, 1, 1), F.lpad(F.substring(c, 2, width), width - 1, "0")))
        .otherwise(F.lpad(c, width, "0"))
    )


def digits_and_commas(c) -> Column:
    """Keep only ``0-9`` and ``,`` (secondary activity code list)."""
    return F.regexp_replace(_c(c), "[^0-9,]", "")


def split_codes(c) -> Column:
    """Comma separated code text -> array<string> without empty items."""
    return F.filter(F.split(_c(c), ","), lambda x: x != "")


def file_base(c) -> Column:
    """File name without trailing part number and archive extension."""
    return F.regexp_replace(_c(c), r"(?i)\d*\.zip|\d*\.tar\.gz", "")


def _first_prefix(lower_base: Column, keys: list[str]) -> Column:
    """The first of ``keys`` (in order) that prefixes ``lower_base``, else ''.

    One anchored alternation replaces a chain of ``startswith`` tests, so the
    base name is derived once per row instead of once per branch.
    """
    alts = "|".join(re.escape(k) for k in keys)
    return F.regexp_extract(lower_base, f"^({alts})", 1)


def _map_equal(c: Column, mapping: dict[str, str]) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out


def file_type(c) -> Column:
    """Entity type of a raw archive name (``Empresas3.zip`` -> ``Empresas``).

    The first layout whose name prefixes the lower-cased base wins; an unknown
    base is returned as is (and is then "not mapped").
    """
    base = file_base(c)
    hit = _first_prefix(F.lower(base), [e.lower() for e in LAYOUTS])
    return F.when(hit != "", _map_equal(hit, {e.lower(): e for e in LAYOUTS})).otherwise(base)


def is_mapped(c) -> Column:
    return file_type(c).isin(list(LAYOUTS))


def parquet_name(c) -> Column:
    """``x.zip`` -> ``x.parquet`` (case-sensitive, every occurrence)."""
    return F.replace(_c(c), F.lit(".zip"), F.lit(".parquet"))


def table_name(c) -> Column:
    """Warehouse table of a processed file name (``Empresas0.parquet`` -> ``cnpj_empresas``)."""
    base = F.lower(F.regexp_replace(_c(c), r"(?i)\d*\.parquet", ""))
    hit = _first_prefix(base, list(TABLES))
    return F.when(hit != "", _map_equal(hit, TABLES)).otherwise(F.concat(F.lit("cnpj_"), base))


def object_key(layer, year_month, file_name) -> Column:
    """``layer/year_month/file`` (null when any part is null)."""
    return F.concat(_c(layer) if not isinstance(layer, str) else F.lit(layer), F.lit("/"),
                    _c(year_month), F.lit("/"), _c(file_name))


def month_of_key(c, compat: bool = False) -> Column:
    """Group key of an object key.

    ``raw/2025-06/a.zip`` -> ``2025-06`` (``raw/2025-06`` with ``compat``),
    ``2025-06/a.parquet`` -> ``2025-06``, ``a.zip`` -> ``ROOT``.
    """
    parts = F.split(_c(c), "/")
    n = F.size(parts)
    layered = (n >= 3) & parts.getItem(0).isin("raw", "processed")
    month = F.concat(parts.getItem(0), F.lit("/"), parts.getItem(1)) if compat else parts.getItem(1)
    return F.when(layered, month).when(n > 1, parts.getItem(0)).otherwise(F.lit("ROOT"))


def layer_of_key(c) -> Column:
    parts = F.split(_c(c), "/")
    return F.when((F.size(parts) >= 3) & parts.getItem(0).isin("raw", "processed"), parts.getItem(0))


def last_component(c) -> Column:
    return F.substring_index(_c(c), "/", -1)


def strip_quotes(c) -> Column:
    """ETag text without surrounding double quotes."""
    return F.regexp_replace(_c(c), '^"+|"+$', "")


def truncate(c, n: int) -> Column:
    return F.substring(_c(c), 1, n)


def has_non_latin1(c) -> Column:
    """True when the text holds a character above U+00FF."""
    return _c(c).rlike(r"[^\x{0}-\x{ff}]")
