"""Registry records as raw lines: a codec between columns and ``;``-separated text (SRC1, SRC3).

``to_lines`` writes a frame's layout columns as lines, ``parse_lines`` reads lines back.
Both run in the JVM inside the stage of their input.  The reader keeps every record: one
with a wrong number of fields has its raw text in ``_corrupt_record``, and a field is
exactly what stands between the separators, an empty one null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiflow.schema import LAYOUTS, raw_schema
from regiflow.sources.csv import CORRUPT, csv_options

WRITE_OPTIONS = {"sep": ";", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
                 "emptyValue": "", "nullValue": "", "escapeQuotes": "true"}


def line_of(entity: str, present: list[str]) -> Column:
    """A record's line: all fields of the layout by position; columns that are not there are empty fields."""
    fields = [F.col(c).cast("string").alias(c) if c in present else F.lit(None).cast("string").alias(c) for c in LAYOUTS[entity]]
    return F.to_csv(F.struct(*fields), WRITE_OPTIONS)


def to_lines(df: DataFrame, entity: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns and ``line``."""
    return df.select(*keep, line_of(entity, df.columns).alias("line"))


def parse_lines(lines: DataFrame, entity: str, column: str = "line", keep: tuple[str, ...] = ()) -> DataFrame:
    """The layout's columns, ``_corrupt_record`` and ``keep`` for each line; a null line has nulls only."""
    schema = raw_schema(entity).add(T.StructField(CORRUPT, T.StringType(), True))
    options = {k: v for k, v in csv_options().items() if k not in ("encoding", "header", "multiLine")}
    record = F.from_csv(F.col(column), schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)
    # generated, not projected: a filter on the parsed fields would otherwise be pushed below and parse once per field
    return lines.select(*keep, F.inline(F.array(record))).select(*LAYOUTS[entity], CORRUPT, *keep)
