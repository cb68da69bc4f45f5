"""Column profiling of raw entity text (null share, distinct count, samples,
number ranges, key lengths) and the issue rules built on it.

The column profile unpivots every row to ``(column_name, value)`` and shuffles
once on that pair (map-side combine collapses repeated values, so a value that
fills a third of a column costs one row per task).  Distinct counts, null
counts and the three smallest sample values all derive from that one grouped
set; the sample uses a ranked window whose group limit Spark applies before
its shuffle, so no column's values are ever gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiflow.functions.formats import percent_text
from regiflow.functions.numbers import decimal_comma
from regiflow.functions.text import has_non_latin1
from regiflow.schema import KEY_WIDTH

SAMPLE_VALUES = 3


def value_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, value, n): every distinct value per column with its count."""
    cols = columns or df.columns
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                                for c in cols])).alias("p")
    return (df.select(pairs).select("p.column_name", "p.value")
            .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))


def profile_columns(df: DataFrame, columns: list[str] | None = None, samples: int = SAMPLE_VALUES) -> DataFrame:
    """Per column: rows, null count/percent, distinct non-null count, first sample values."""
    vc = value_counts(df, columns)
    stats = vc.groupBy("column_name").agg(
        F.sum("n").cast("bigint").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("null_count"),
        F.count_if(F.col("value").isNotNull()).alias("unique_count"))
    # Nulls sort last and collect_list drops them, so both branches read the
    # same grouped set (no pushed filter) and share one shuffle.
    w = Window.partitionBy("column_name").orderBy(F.col("value").asc_nulls_last())
    top = (vc.withColumn("rk", F.row_number().over(w))
           .where(F.col("rk") <= samples)
           .groupBy("column_name")
           .agg(F.array_join(F.array_sort(F.collect_list("value")), " | ").alias("sample_values")))
    return (stats.join(top, "column_name", "left")
            .withColumn("null_pct", percent_text(F.col("null_count"), F.col("row_count")))
            .withColumn("all_null", (F.col("null_count") == F.col("row_count")) & (F.col("row_count") > 0)))


def profile_columns_approx(df: DataFrame, columns: list[str] | None = None, rsd: float = 0.01) -> DataFrame:
    """One-pass profile without a data shuffle: HyperLogLog distinct counts.

    Every statistic is a partial aggregate (one row per task is shuffled), so
    the cost is one scan regardless of column cardinality; ``sample_values``
    holds the smallest value only.  Use when the exact profile's pair shuffle
    (rows x columns) is too heavy.
    """
    cols = columns or df.columns
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        v = F.col(c).cast("string")
        aggs += [F.count_if(v.isNull()).alias(f"__n{i}"), F.approx_count_distinct(v, rsd).alias(f"__u{i}"),
                 F.min(v).alias(f"__s{i}")]
    row = df.agg(*aggs)
    items = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("__rows").alias("row_count"),
                               F.col(f"__n{i}").alias("null_count"), F.col(f"__u{i}").alias("unique_count"),
                               F.col(f"__s{i}").alias("sample_values")) for i, c in enumerate(cols)])
    return (row.select(F.explode(items).alias("p")).select("p.*")
            .withColumn("null_pct", percent_text(F.col("null_count"), F.col("row_count")))
            .withColumn("all_null", (F.col("null_count") == F.col("row_count")) & (F.col("row_count") > 0)))


def profile_number(df: DataFrame, column: str = "capital_social") -> DataFrame:
    """min / max / zeros / negatives of a decimal-comma text column (per-row parse)."""
    v = decimal_comma(F.col(column))
    return df.agg(
        F.lit(column).alias("column_name"),
        F.count_if(F.col(column).isNotNull()).alias("non_null"),
        F.count_if(F.col(column).isNotNull() & v.isNull()).alias("unparsable"),
        F.min(v).alias("min"), F.max(v).alias("max"),
        F.count_if(v == 0).alias("zeros"), F.count_if(v < 0).alias("negatives"))


def key_length_hist(df: DataFrame, key: str = "cnpj_basico") -> DataFrame:
    """Histogram of key lengths (non-null keys) with an expected-length flag."""
    return (df.where(F.col(key).isNotNull()).groupBy(F.length(key).alias("key_length"))
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("expected", F.col("key_length") == KEY_WIDTH))


def key_lengths_ok(hist: DataFrame) -> DataFrame:
    """One row: are all found lengths within {8}? (subset test)."""
    return hist.agg(F.every(F.col("expected")).alias("lengths_ok"),
                    F.count(F.lit(1)).alias("distinct_lengths"))


def profile_issues(raw: DataFrame, key: str = "cnpj_basico", name: str = "razao_social",
                   number: str = "capital_social") -> DataFrame:
    """Issue/warning rows (severity, code, count) from one aggregate over the data.

    Rules: negative numbers, null keys, keys of unexpected length (warning),
    text with characters above U+00FF, columns that are entirely null (warning).
    """
    cols = raw.columns
    aggs = [F.count(F.lit(1)).alias("__rows")]
    if number in cols:
        aggs.append(F.count_if(decimal_comma(F.col(number)) < 0).alias("negative_" + number))
    if key in cols:
        aggs.append(F.count_if(F.col(key).isNull()).alias("null_" + key))
        aggs.append(F.count_if(F.col(key).isNotNull() & (F.length(key) != KEY_WIDTH)).alias("length_" + key))
    if name in cols:
        aggs.append(F.count_if(has_non_latin1(F.col(name))).alias("encoding_" + name))
    aggs += [F.count_if(F.col(c).isNotNull()).alias("nonnull__" + c) for c in cols]
    row = raw.agg(*aggs)
    rules = []
    if number in cols:
        rules.append(("issue", "negative_values", number, F.col("negative_" + number)))
    if key in cols:
        rules.append(("issue", "null_key", key, F.col("null_" + key)))
        rules.append(("warning", "unexpected_key_length", key, F.col("length_" + key)))
    if name in cols:
        rules.append(("issue", "non_latin1_text", name, F.col("encoding_" + name)))
    rules += [("warning", "all_null_column", c,
               F.when((F.col("nonnull__" + c) == 0) & (F.col("__rows") > 0), F.col("__rows")).otherwise(F.lit(0)))
              for c in cols]
    items = F.array(*[F.struct(F.lit(s).alias("severity"), F.lit(code).alias("code"), F.lit(c).alias("column_name"),
                               n.cast("bigint").alias("n")) for s, code, c, n in rules])
    return (row.select(F.explode(F.filter(items, lambda x: x["n"] > 0)).alias("r"))
            .select("r.severity", "r.code", "r.column_name", "r.n"))


def file_profile(files: DataFrame, size_col: str = "local_size_bytes", expansion: int = 7,
                 parquet_fraction: float = 0.25) -> DataFrame:
    """Per month: files, mapped/unmapped counts and capacity estimates (DQ7, MTH3)."""
    from regiflow.functions.text import is_mapped
    size = F.coalesce(F.col(size_col), F.lit(0))
    return files.groupBy("year_month").agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(is_mapped(F.col("file_name"))).alias("mapped"),
        F.count_if(~is_mapped(F.col("file_name"))).alias("unmapped"),
        F.sum(size).cast("bigint").alias("total_raw_bytes"),
        F.round(F.sum(size) * F.lit(float(expansion)) / F.lit(1024.0 ** 2), 1).alias("estimated_ram_mb"),
        F.round(F.sum(size) * F.lit(expansion * parquet_fraction) / F.lit(1024.0 ** 3), 1).alias("estimated_parquet_gb"))
