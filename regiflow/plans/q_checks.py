"""Queries that meet every rule: typed rejects of all entities, issue rules, file hashes, run log, one file's state."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiflow.operators import control as C
from regiflow.operators import ml as M
from regiflow.operators import profile as P
from regiflow.operators.casting import rejects
from regiflow.operators.rules import clean_na
from regiflow.plans import oracle as O
from regiflow.plans import records as R
from regiflow.plans import silver
from regiflow.plans import standins as S
from regiflow.plans.catalog import ORACLES, register
from regiflow.plans.q_ml import classifier_metrics
from regiflow.plans.q_quality import _COMP_TEXT, _TEXT_COLS, _issues_sql
from regiflow.schema import LAYOUTS, TYPED
from regiflow.sources.listing import hash_files_streaming, inventory
from regiflow.sources.lines import to_lines

ONE_MONTH, ONE_FILE = "1993-01", "Simples39.ZIP"


def _rejects_sql(entity: str) -> str:
    """Values that cannot be loaded, column by column; the rules of ``casting`` in SQL."""
    clean = f"(SELECT {', '.join(f'{O.na(c)} AS {c}' for c in LAYOUTS[entity])} FROM ({R.raw_sql(entity)}) r)"
    key = "cnpj_basico" if "cnpj_basico" in LAYOUTS[entity] else "CAST(NULL AS VARCHAR)"
    parts = []
    for c, (kind, most) in TYPED[entity].items():
        if isinstance(kind, T.DateType):
            bad, reason = f"{O.date_typed(c)} IS NULL AND {O.date_text(c)} IS NOT NULL", "invalid_date"
        elif isinstance(kind, T.DecimalType):
            bad, reason = f"TRY_CAST(replace({O.strip(c)}, ',', '.') AS DECIMAL(15,2)) IS NULL", "invalid_decimal"
        elif isinstance(kind, T.IntegerType):
            bad, reason = f"TRY_CAST({O.strip(c)} AS INTEGER) IS NULL", "invalid_int"
        else:
            bad, reason = "FALSE", ""
        long = f" WHEN length({c}) > {most} THEN 'too_long_{most}'" if most is not None else ""
        parts.append(f"SELECT '{entity}' AS entity, {key} AS record_key, '{c}' AS column_name, {c} AS raw_value, "
                     f"CASE WHEN {c} IS NOT NULL AND {bad} THEN '{reason}'{long} END AS reason FROM {clean} s")
    return " UNION ALL ".join(parts)


@register("typed_rejects_all", f"SELECT * FROM ({' UNION ALL '.join(_rejects_sql(e) for e in LAYOUTS)}) r WHERE reason IS NOT NULL",
          "CST1 ENT7 rejects of all ten entities and all their columns")
def typed_rejects_all(spark, sf):
    one = lambda e: rejects(clean_na(R.records(spark, sf, e).drop("_k")), e).select(F.lit(e).alias("entity"), "record_key", "column_name", "raw_value", "reason")
    return reduce(lambda a, b: a.unionByName(b), map(one, LAYOUTS))


_ODD_SQL = f"""(SELECT cnpj_basico, CASE WHEN cnpj_basico LIKE '%7' THEN razao_social || ' Łódź' ELSE razao_social END AS razao_social, natureza_juridica,
  qualificacao_responsavel, capital_social, CAST(NULL AS VARCHAR) AS porte_empresa, ente_federativo_responsavel FROM {_COMP_TEXT} c)"""


@register("profile_issues_odd", _issues_sql(_ODD_SQL, _TEXT_COLS), "DQ6 STR16 characters beyond ISO-8859-1, a column without values")
def profile_issues_odd(spark, sf):
    text = silver.companies_text(spark, sf)
    odd = F.when(F.col("cnpj_basico").like("%7"), F.concat("razao_social", F.lit(" Łódź"))).otherwise(F.col("razao_social"))
    return P.profile_issues(text.withColumns({"razao_social": odd, "porte_empresa": F.lit(None).cast("string")}))


def _hash_sql() -> str:
    field = lambda c: f"CASE WHEN contains({c}, ';') OR contains({c}, '\"') THEN '\"' || replace({c}, '\"', '\"\"') || '\"' ELSE coalesce({c}, '') END"
    line = " || ';' || ".join(field(c) for c in LAYOUTS["Cnaes"])
    return (f"SELECT source_file, sha256(string_agg(line, chr(10) ORDER BY line) || chr(10)) AS content_hash FROM (SELECT {R.part_sql('Cnaes')} AS source_file, "
            f"{line} AS line FROM ({R.raw_sql('Cnaes')}) r) l GROUP BY source_file")


@register("hash_files", _hash_sql(), "HSH1 SHA-256 of files as byte streams")
def hash_files(spark, sf):
    folder = R.shared_folder(spark, "hashed")
    part = F.concat(F.lit("Cnaes"), F.pmod("_k", F.lit(R.PARTS)), F.lit(".csv"))
    lines = to_lines(R.records(spark, sf, "Cnaes").withColumn("source_file", part), "Cnaes", keep=("source_file",))
    lines.repartition("source_file").sortWithinPartitions("source_file", "line").write.partitionBy("source_file").text(folder)
    files = inventory(spark, folder, "part-*").select("path")
    return hash_files_streaming(files).select(F.regexp_extract("path", "source_file=([^/]+)/", 1).alias("source_file"), "content_hash")


@register("run_log", f"""
SELECT m.tp, m.fp, m.fn, m.tn, m.accuracy, m.precision, m.recall, m.f1, r.model, r.seed FROM ({ORACLES['classifier_metrics']}) m,
  (VALUES ('rule', '1'), ('rule', '2')) r(model, seed)""", "ML9 parameters and metrics of runs are appended and read back")
def run_log(spark, sf):
    path = R.shared_folder(spark, "runs")
    metrics = classifier_metrics(spark, sf)
    for seed in (1, 2):
        M.log_run(metrics, {"model": "rule", "seed": seed}, path)
    return spark.read.parquet(path).drop("run_at")


@register("file_state", f"""
SELECT year_month, file_name, status, file_size_bytes FROM ({O.CONTROL}) c WHERE year_month = '{ONE_MONTH}' AND file_name = '{ONE_FILE}'
UNION ALL SELECT year_month, file_name, status, file_size_bytes FROM ({O.CONTROL}) c WHERE year_month = '{ONE_MONTH}' AND status = 'error'""",
          "FLT4 SRT1 CTL6 one file by (month, name); a month's files in error by name")
def file_state(spark, sf):
    month = C.month_detail(S.control(spark, sf), ONE_MONTH)
    cols = ["year_month", "file_name", "status", "file_size_bytes"]
    return month.where(F.col("file_name") == ONE_FILE).select(*cols).unionByName(month.where("status = 'error'").select(*cols))
