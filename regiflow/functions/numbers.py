"""Numeric column functions: decimal-comma parsing, size units, rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regiflow.functions.text import _c, strip_unicode


# Plain decimal numbers; a cast alone also takes Java forms such as ``5d``, ``10F`` or ``0x1p3``.
PLAIN_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _plain_double(text: Column) -> Column:
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))


def decimal_comma(c) -> Column:
    """``'1000,50'`` -> 1000.5 (double); unparsable or NaN text -> null.

    Thousands separators (``1.000,50``) are not guessed: they fail to parse.
    """
    return _plain_double(F.replace(strip_unicode(_c(c)), F.lit(","), F.lit(".")))


def decimal_comma_decimal(c, precision: int = 15, scale: int = 2) -> Column:
    """Decimal-comma text -> DECIMAL(p, s) (HALF_UP), null when unparsable."""
    txt = F.replace(strip_unicode(_c(c)), F.lit(","), F.lit("."))
    return txt.try_cast(f"decimal({precision},{scale})")


def coerce_number(c, default: float = 0.0) -> Column:
    """Any value -> double, unparsable -> ``default``."""
    return F.coalesce(_plain_double(F.trim(_c(c).cast("string"))), F.lit(default))


def to_mb(c, digits: int = 1) -> Column:
    return F.round(_c(c) / F.lit(1024.0 ** 2), digits)


def to_gb(c, digits: int = 2) -> Column:
    return F.round(_c(c) / F.lit(1024.0 ** 3), digits)


def safe_ratio(num, den) -> Column:
    """``num / den`` as double, null when ``den`` is 0 or null."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def rate_mb_per_s(bytes_col, seconds_col) -> Column:
    """Transfer rate in MB/s (null when no time elapsed)."""
    return F.try_divide(_c(bytes_col) / F.lit(1024.0 ** 2), F.when(_c(seconds_col) > 0, _c(seconds_col)))


def progress_pct(done_col, total_col, digits: int = 1) -> Column:
    """Download progress in percent, 0 when the total is unknown."""
    return F.coalesce(F.round(F.try_divide(_c(done_col) * F.lit(100.0), F.when(_c(total_col) > 0, _c(total_col))), digits),
                      F.lit(0.0))
