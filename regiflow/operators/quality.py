"""Data-quality expectations evaluated as one aggregate per table.

An expectation suite becomes a single ``agg`` of ``count_if`` columns (one
scan, partial aggregation, no shuffle of rows), unpivoted to one result row
per expectation.  A checkpoint is ``every(success)`` over suites.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiflow.schema import KEY_WIDTH, SIMPLES_OPTION_VALUES


@dataclass(frozen=True)
class Expectation:
    kind: str          # not_null | length_equals | in_set
    column: str
    value: object = None

    @property
    def name(self) -> str:
        return {"not_null": "expect_column_values_to_not_be_null",
                "length_equals": "expect_column_value_lengths_to_equal",
                "in_set": "expect_column_values_to_be_in_set"}[self.kind]

    def unexpected(self) -> Column:
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "length_equals":
            return c.isNotNull() & (F.length(c) != F.lit(int(self.value)))
        if self.kind == "in_set":
            return c.isNotNull() & ~c.isin(list(self.value))
        raise ValueError(self.kind)

    def checked(self) -> Column:
        """Rows the expectation is evaluated on (nulls ignored except for not_null)."""
        return F.lit(True) if self.kind == "not_null" else F.col(self.column).isNotNull()


def not_null(column: str) -> Expectation:
    return Expectation("not_null", column)


def length_equals(column: str, n: int) -> Expectation:
    return Expectation("length_equals", column, n)


def in_set(column: str, values) -> Expectation:
    return Expectation("in_set", column, tuple(values))


# The reference suites.
COMPANY_SUITE = [not_null("cnpj_basico"), length_equals("cnpj_basico", KEY_WIDTH)]
SIMPLES_SUITE = [in_set("opcao_pelo_simples", SIMPLES_OPTION_VALUES)]


def run_suite(df: DataFrame, suite: str, expectations: list[Expectation]) -> DataFrame:
    """One row per expectation: element_count, checked_count, unexpected_count, success."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, e in enumerate(expectations):
        aggs += [F.count_if(e.checked()).alias(f"__c{i}"), F.count_if(e.unexpected()).alias(f"__u{i}")]
    row = df.agg(*aggs)
    items = F.array(*[
        F.struct(F.lit(i).alias("idx"), F.lit(e.name).alias("expectation"), F.lit(e.column).alias("column_name"),
                 F.col(f"__c{i}").alias("checked_count"), F.col(f"__u{i}").alias("unexpected_count"))
        for i, e in enumerate(expectations)])
    return (row.select(F.col("__n").alias("element_count"), F.explode(items).alias("e"))
            .select(F.lit(suite).alias("suite"), "e.idx", "e.expectation", "e.column_name", "element_count",
                    "e.checked_count", "e.unexpected_count",
                    (F.col("e.unexpected_count") == 0).alias("success")))


def checkpoint(results: DataFrame) -> DataFrame:
    """Per suite success (all expectations passed)."""
    return results.groupBy("suite").agg(F.every("success").alias("success"),
                                        F.count(F.lit(1)).alias("expectations"),
                                        F.count_if(~F.col("success")).alias("failed"))


def assert_checkpoint(results: DataFrame) -> None:
    """Raise when any expectation failed (the only driver-side read: one tiny row)."""
    row = results.agg(F.every("success").alias("ok"), F.count_if(~F.col("success")).alias("failed")).first()
    if row is not None and row["ok"] is False:
        raise AssertionError(f"data quality checkpoint failed: {row['failed']} expectation(s)")
