"""Human-readable text: byte sizes, durations, percentages.

Ties are rounded to even before ``%.1f``, so 1280 bytes are ``1.2 KB``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regiflow.functions.text import _c
from regiflow.schema import ETA_PLACEHOLDER

# Unit names and step of the byte formatter.
BYTE_UNITS = ["B", "KB", "MB", "GB", "TB"]
BYTE_LAST_UNIT = "PB"
BYTE_STEP = 1024.0


def human_bytes(c) -> Column:
    """Bytes -> ``'12.3 MB'`` with one decimal and 1024 steps (B..PB)."""
    size = _c(c).cast("double")
    out = None
    for i, unit in enumerate(BYTE_UNITS):
        scaled = size / F.lit(BYTE_STEP ** i)
        cond = F.abs(scaled) < F.lit(BYTE_STEP)
        txt = F.format_string("%.1f %s", F.bround(scaled, 1), F.lit(unit))
        out = F.when(cond, txt) if out is None else out.when(cond, txt)
    last = F.format_string("%.1f %s", F.bround(size / F.lit(BYTE_STEP ** len(BYTE_UNITS)), 1), F.lit(BYTE_LAST_UNIT))
    return F.when(size.isNull(), F.lit(None).cast("string")).otherwise(out.otherwise(last))


def eta_text(c) -> Column:
    """Seconds -> ``1h02m03s`` / ``2m03s`` / ``3s``; negative or > 1 day -> placeholder."""
    s = _c(c).cast("double")
    whole = F.floor(s).cast("long")
    h = F.floor(whole / 3600).cast("long")
    m = F.floor((whole % 3600) / 60).cast("long")
    sec = (whole % 60).cast("long")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return (
        F.when(s.isNull(), F.lit(None).cast("string"))
        .when((s < 0) | (s > 86400), F.lit(ETA_PLACEHOLDER))
        .when(h > 0, F.concat(h.cast("string"), F.lit("h"), two(m), F.lit("m"), two(sec), F.lit("s")))
        .when(m > 0, F.concat(m.cast("string"), F.lit("m"), two(sec), F.lit("s")))
        .otherwise(F.concat(sec.cast("string"), F.lit("s")))
    )


def percent_text(value, total) -> Column:
    """``'12.5%'`` with one decimal, ``'N/A'`` when the total is 0."""
    v, t = _c(value).cast("double"), _c(total).cast("double")
    return F.when(v.isNull() | t.isNull(), F.lit(None).cast("string")).when(t == 0, F.lit("N/A")).otherwise(
        F.format_string("%.1f%%", F.bround(F.lit(100.0) * v / t, 1)))
