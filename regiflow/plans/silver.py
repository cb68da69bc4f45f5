"""Silver (cleaned) registry entities built from the stand-in raw text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regiflow.operators.rules import clean_na, normalize
from regiflow.plans import standins as S


def companies(spark: SparkSession, sf: str) -> DataFrame:
    return normalize(S.raw_companies(spark, sf), "Empresas")


def establishments(spark: SparkSession, sf: str) -> DataFrame:
    return normalize(S.raw_establishments(spark, sf), "Estabelecimentos")


def partners(spark: SparkSession, sf: str) -> DataFrame:
    return normalize(S.raw_partners(spark, sf), "Socios")


def simples(spark: SparkSession, sf: str) -> DataFrame:
    return normalize(S.raw_simples(spark, sf), "Simples")


def companies_text(spark: SparkSession, sf: str) -> DataFrame:
    """Raw company text with NA tokens nulled (input of typed casting)."""
    return clean_na(S.raw_companies(spark, sf))


def establishments_text(spark: SparkSession, sf: str) -> DataFrame:
    return clean_na(S.raw_establishments(spark, sf))
