"""Column profiles as mergeable states (AGG8, AGG9, DQ5, DQ7).

``file_states`` profiles each file of a frame in one pass: per file and column the rows,
nulls, smallest and largest value and a theta sketch of the distinct ones.  Only a state
per task, file and column is shuffled, however many rows there are.  States are kept, so
a month's or an entity's profile merges those of its files without reading them again,
and a new file adds its own.

A theta sketch holds the hashes of up to 2**``LG_NOMINAL`` distinct values: until then its
count is exact, beyond it has a relative standard error of 1 / sqrt(2**LG_NOMINAL), 1.6 %.
``unique_exact`` tells which.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiflow.functions.formats import percent_text
from regiflow.schema import KEY_WIDTH

LG_NOMINAL = 12
EXACT_UP_TO = (1 << LG_NOMINAL) - 1


def file_states(df: DataFrame, by: tuple[str, ...] = ("source_file",), columns: list[str] | None = None) -> DataFrame:
    """(*by, column_name, row_count, null_count, odd_length, min_value, max_value, sketch)."""
    columns = columns or [c for c in df.columns if c not in by]
    text = {c: F.col(c).cast("string") for c in columns}
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(columns):
        aggs += [F.count(text[c]).alias(f"_n{i}"), F.count_if(F.length(text[c]) != KEY_WIDTH).alias(f"_l{i}"), F.min(text[c]).alias(f"_a{i}"),
                 F.max(text[c]).alias(f"_z{i}"), F.theta_sketch_agg(text[c], LG_NOMINAL).alias(f"_s{i}")]
    states = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("_rows").alias("row_count"), (F.col("_rows") - F.col(f"_n{i}")).alias("null_count"),
                                F.col(f"_l{i}").alias("odd_length"), F.col(f"_a{i}").alias("min_value"), F.col(f"_z{i}").alias("max_value"),
                                F.col(f"_s{i}").alias("sketch")) for i, c in enumerate(columns)])
    return df.groupBy(*by).agg(*aggs).select(*by, F.inline(states))


def merged(states: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Profiles of all files together, or per group of them: counts, value range, distinct values."""
    out = states.groupBy(*by, "column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"), F.sum("odd_length").alias("odd_length"),
        F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
        F.theta_sketch_estimate(F.theta_union_agg("sketch", LG_NOMINAL)).cast("long").alias("unique_count"))
    return (out.withColumn("unique_exact", F.col("unique_count") <= EXACT_UP_TO)
            .withColumn("null_pct", percent_text(F.col("null_count"), F.col("row_count"))))


def issue_totals(profiles: DataFrame, by: tuple[str, ...], key: str = "cnpj_basico") -> DataFrame:
    """(*by, issues, warnings, null_keys, odd_keys, empty_columns) from merged profiles.

    A key column with nulls is an issue; keys of another length and columns without values are warnings.
    """
    is_key = F.col("column_name") == key
    empty = (F.col("null_count") == F.col("row_count")) & (F.col("row_count") > 0)
    at = lambda cond, what: F.coalesce(F.sum(F.when(cond, what)), F.lit(0)).cast("long")
    out = profiles.groupBy(*by).agg(at(is_key, F.col("null_count")).alias("null_keys"), at(is_key, F.col("odd_length")).alias("odd_keys"),
                                    F.count_if(empty).alias("empty_columns"))
    return out.select(*by, (F.col("null_keys") > 0).cast("int").alias("issues"),
                      ((F.col("odd_keys") > 0).cast("int") + F.col("empty_columns")).cast("long").alias("warnings"), "null_keys", "odd_keys", "empty_columns")
