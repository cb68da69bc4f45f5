"""Queries on warehouse structures that are built from the tables first: runs, footers, indexes."""

from __future__ import annotations

from pyspark.sql import functions as F

from regiflow.operators import pages, trigrams
from regiflow.operators.registry import lookup_key, lookup_keys
from regiflow.operators.casting import to_typed
from regiflow.plans import oracle as O
from regiflow.plans import records as R
from regiflow.plans import silver
from regiflow.plans.catalog import register
from regiflow.plans.q_entities import _LIST_SQL, LOOKUP_KEY, SEARCH_TERM, WILDCARD_TERM
from regiflow.sinks import transaction
from regiflow.sinks.layout import write_keyed
from regiflow.sources.footers import footer_statistics

DEEP_OFFSET, DEEP_LIMIT = 700, 50
MONTHS, FILE_ROWS = 3, 500_000        # months of the processed files; rows of one of a file's pieces, about
_ORDER = "cnpj_basico NULLS LAST, razao_social NULLS LAST, natureza_juridica NULLS LAST, capital_social NULLS LAST, porte_empresa NULLS LAST"
_COMP = f"({O.companies_sql()})"


@register("run_transaction", f"""
SELECT 'companies' AS table_name, 0::BIGINT AS before_publish, (SELECT count(*) FROM customer) AS after_publish
UNION ALL SELECT 'simples', 0, (SELECT count(*) FROM ({O.RAW_SIMPLES}) s)""",
          "SNK4 SNK5 SNK8 SNK9 a run's tables are published together; loading its parts again doubles nothing")
def run_transaction(spark, sf):
    root = R.shared_folder(spark, "warehouse")
    part = F.concat(F.lit("part"), F.pmod(F.xxhash64("cnpj_basico"), F.lit(4)))
    frames = {"companies": to_typed(silver.companies(spark, sf), "Empresas"), "simples": to_typed(silver.simples(spark, sf), "Simples")}
    frames = {t: df.withColumn("source_file", part) for t, df in frames.items()}

    def visible(table):
        df = transaction.read_table(spark, root, table)
        return 0 if df is None else df.count()

    for again in range(2):                   # the second run brings the same parts
        run = transaction.Run(spark, root)
        for t, df in frames.items():
            run.stage(t, df, "append", ("source_file",))
        before = {t: visible(t) for t in frames} if not again else before
        run.publish()
    counts = [transaction.read_table(spark, root, t).agg(F.lit(t).alias("table_name"), F.lit(before[t]).cast("long").alias("before_publish"),
                                                         F.count(F.lit(1)).alias("after_publish")) for t in frames]
    return counts[0].unionByName(counts[1])


@register("footer_row_counts", f"""
SELECT '2025-0' || (1 + _k % 3) AS year_month, {R.part_sql('Socios', 'parquet')} AS source_file, count(*) AS row_count, true AS has_bytes
FROM ({R.raw_sql('Socios')}) r GROUP BY 1, 2""", "SRC5 rows per processed file from footers, by month")
def footer_row_counts(spark, sf):
    folder = R.shared_folder(spark, "processed")
    df = R.records(spark, sf, "Socios").withColumn("year_month", F.concat(F.lit("2025-0"), F.col("_k") % 3 + 1)).withColumn(
        "source_file", F.concat(F.lit("Socios"), F.pmod("_k", F.lit(R.PARTS)), F.lit(".parquet"))).drop("_k")
    # a processed file may hold a share of all rows: it is written in pieces by as many tasks, so a task's rows stay bounded
    pieces = 1 + df.count() // (MONTHS * R.PARTS * FILE_ROWS)
    piece = F.pmod(F.xxhash64(*df.columns), F.lit(pieces))
    df.repartition(2 * MONTHS * R.PARTS * pieces, "year_month", "source_file", piece).write.partitionBy("year_month", "source_file").parquet(folder)
    return footer_statistics(spark, folder).select("year_month", "source_file", "row_count", (F.col("size_bytes") > 0).alias("has_bytes"))


def _indexed(spark, sf):
    return trigrams.build(silver.companies(spark, sf), R.shared_folder(spark, "trigrams"))


@register("search_indexed", f"SELECT {_LIST_SQL} FROM {_COMP} c WHERE razao_social ILIKE '%{SEARCH_TERM}%'", "FLT2 QRY2 trigram postings, then verified")
def search_indexed(spark, sf):
    return trigrams.search(_indexed(spark, sf), SEARCH_TERM)


@register("search_indexed_wildcard", f"SELECT {_LIST_SQL} FROM {_COMP} c WHERE razao_social ILIKE '%{WILDCARD_TERM}%'", "FLT2 QRY2 wildcards cut the term")
def search_indexed_wildcard(spark, sf):
    return trigrams.search(_indexed(spark, sf), WILDCARD_TERM)


@register("list_page_deep", f"SELECT {_LIST_SQL} FROM {_COMP} c ORDER BY {_ORDER} LIMIT {DEEP_LIMIT} OFFSET {DEEP_OFFSET}", "SRT3 QRY1 a page by its range")
def list_page_deep(spark, sf):
    index = pages.build(silver.companies(spark, sf), R.shared_folder(spark, "pages"), range_rows=500)
    return pages.page(index, DEEP_LIMIT, DEEP_OFFSET)


_DETAIL_SQL = ("cnpj_basico, razao_social, natureza_juridica, qualificacao_responsavel, capital_social, porte_empresa, ente_federativo_responsavel")


@register("lookup_key_bucketed", f"SELECT {_DETAIL_SQL} FROM {_COMP} c WHERE cnpj_basico = '{LOOKUP_KEY}'", "QRY3 FLT1 one bucket is read")
def lookup_key_bucketed(spark, sf):
    return lookup_key(write_keyed(silver.companies(spark, sf), R.shared_folder(spark, "keyed"), bucket_rows=200), LOOKUP_KEY)


@register("lookup_batch_bucketed", f"""
SELECT {_DETAIL_SQL} FROM {_COMP} c
WHERE cnpj_basico IN (SELECT cnpj_basico FROM ({O.simples_sql()}) s WHERE opcao_pelo_simples = 'S')""", "QRY3 FLT8 keys joined bucket by bucket")
def lookup_batch_bucketed(spark, sf):
    companies = write_keyed(silver.companies(spark, sf), R.shared_folder(spark, "keyed"), bucket_rows=200)
    return lookup_keys(companies, silver.simples(spark, sf).where(F.col("opcao_pelo_simples") == "S").select("cnpj_basico"))
