"""Date column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regiflow.functions.text import _c, strip_unicode
from regiflow.schema import DATE_NULL_TOKENS


def normalize_date_text(c) -> Column:
    """Registry date text -> ISO text, kept as a string (silver form).

    null / no-date tokens -> null; eight digits -> ``YYYY-MM-DD`` without a
    calendar check (``20231345`` -> ``2023-13-45``); anything else -> the
    stripped text.
    """
    s = strip_unicode(_c(c))
    iso = F.regexp_replace(s, "^([0-9]{4})([0-9]{2})([0-9]{2})$", "$1-$2-$3")
    return F.when(s.isin(DATE_NULL_TOKENS), F.lit(None).cast("string")).otherwise(iso)


def to_date_typed(c, fmt: str = "yyyy-MM-dd") -> Column:
    """Normalised date text -> DateType; impossible dates become null."""
    return F.try_to_date(normalize_date_text(c), fmt)


def year_month(c) -> Column:
    """Timestamp/date -> ``yyyy-MM`` text."""
    return F.date_format(_c(c), "yyyy-MM")


def iso_text(c) -> Column:
    """Timestamp -> ISO-8601 text (``2025-06-01T12:00:00``, microseconds when present)."""
    ts = _c(c)
    frac = F.date_format(ts, "SSSSSS")
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(frac == "000000", base).otherwise(F.concat(base, F.lit("."), frac))


def now_utc() -> Column:
    """Current timestamp of the query (session time zone is UTC)."""
    return F.current_timestamp()
