"""Silver -> typed (gold) casting with a reject table.

A value that fails its cast (or exceeds its declared length) becomes null in
the typed row and produces one reject row ``(key, column, raw_value, reason)``.
Both outputs come from the same narrow projection; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiflow.functions.dates import normalize_date_text
from regiflow.functions.text import strip_unicode
from regiflow.schema import TYPED


def _typed(c: str, dtype: T.DataType) -> Column:
    col = F.col(c)
    if isinstance(dtype, T.DateType):
        return F.try_to_date(normalize_date_text(col), "yyyy-MM-dd")
    if isinstance(dtype, T.DecimalType):
        txt = F.replace(strip_unicode(col.cast("string")), F.lit(","), F.lit("."))
        return txt.try_cast(dtype.simpleString())
    if isinstance(dtype, (T.IntegerType, T.LongType)):
        return strip_unicode(col.cast("string")).try_cast(dtype.simpleString())
    return col.cast("string")


def _reason(c: str, dtype: T.DataType, max_len: int | None) -> Column:
    col, typed = F.col(c), _typed(c, dtype)
    bad_cast = col.isNotNull() & typed.isNull()
    if isinstance(dtype, T.DateType):
        bad_cast = bad_cast & normalize_date_text(col).isNotNull()
    out = F.when(bad_cast, F.lit(f"invalid_{dtype.simpleString().split('(')[0]}"))
    if max_len is not None:
        out = out.when(F.length(col.cast("string")) > max_len, F.lit(f"too_long_{max_len}"))
    return out


def typed_columns(df: DataFrame, entity: str) -> dict[str, Column]:
    return {c: _typed(c, t) for c, (t, _) in TYPED[entity].items() if c in df.columns}


def to_typed(df: DataFrame, entity: str) -> DataFrame:
    """Typed projection; over-long strings are kept (reported, never truncated)."""
    return df.withColumns(typed_columns(df, entity))


def rejects(df: DataFrame, entity: str, key: str = "cnpj_basico", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per (record, column) whose value cannot be loaded."""
    spec = [(c, t, n) for c, (t, n) in TYPED[entity].items() if c in df.columns]
    items = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("raw_value"),
                 _reason(c, t, n).alias("reason"))
        for c, t, n in spec
    ])
    key_col = F.col(key) if key in df.columns else F.lit(None).cast("string")
    # explode of an empty array emits nothing, so no filter is needed; a filter
    # on the derived array would be pushed below every projection and inline
    # the whole expression tree into the scan-side predicate.
    return (
        df.select(*keep, key_col.alias("record_key"),
                  F.explode(F.filter(items, lambda x: x["reason"].isNotNull())).alias("r"))
        .select(*keep, "record_key", "r.column_name", "r.raw_value", "r.reason")
    )


def split_typed(df: DataFrame, entity: str, key: str = "cnpj_basico") -> tuple[DataFrame, DataFrame]:
    """(typed rows, reject rows).  Silver rows = typed rows; rejects explain nulls."""
    return to_typed(df, entity), rejects(df, entity, key)
