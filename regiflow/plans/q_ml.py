"""Queries: training sets, encoders, metrics, random-forest training and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from regiflow.operators import ml as M
from regiflow.plans import oracle as O
from regiflow.plans import silver
from regiflow.plans.catalog import register
from regiflow.session import checkpoint_dir

_COMP = f"({O.companies_sql()})"
_SIMP = f"({O.simples_sql()})"
_EST = f"({O.establishments_sql()})"

# Fixed rule used to check the metric aggregate against SQL.
RULE_CAPITAL = 5000.0

_TRAIN_A = f"""
SELECT c.cnpj_basico, c.natureza_juridica, c.capital_social, c.porte_empresa, s.opcao_pelo_simples,
  CASE WHEN s.opcao_pelo_simples = 'S' THEN 1 ELSE 0 END AS target
FROM {_COMP} c JOIN {_SIMP} s ON c.cnpj_basico = s.cnpj_basico
WHERE s.opcao_pelo_simples IN ('S', 'N') AND c.natureza_juridica IS NOT NULL AND c.capital_social IS NOT NULL
  AND c.porte_empresa IS NOT NULL"""


@register("train_set_simples", _TRAIN_A, "ML1 JN1 FLT3 FLT10 PRJ2 PRJ3")
def train_set_simples(spark, sf):
    return M.training_set_simples(silver.companies(spark, sf), silver.simples(spark, sf))


_TRAIN_B = f"""
SELECT c.cnpj_basico, coalesce(c.capital_social, 0.0) AS capital_social, c.natureza_juridica, c.porte_empresa,
  coalesce(s.opcao_pelo_simples, 'N') AS opcao_pelo_simples, e.cnae_fiscal_principal
FROM {_COMP} c
LEFT JOIN {_SIMP} s ON c.cnpj_basico = s.cnpj_basico
JOIN (SELECT cnpj_basico, cnae_fiscal_principal FROM {_EST} x
      WHERE TRY_CAST(identificador_matriz_filial AS INTEGER) = 1) e ON c.cnpj_basico = e.cnpj_basico
WHERE c.porte_empresa IS NOT NULL AND c.porte_empresa <> '' AND c.porte_empresa IN ('01', '03', '05')"""


@register("train_set_size", _TRAIN_B, "ML3 ML4 JN2 FLT5 NUL1 STR5")
def train_set_size(spark, sf):
    return M.training_set_size(silver.companies(spark, sf), silver.simples(spark, sf),
                               silver.establishments(spark, sf))


@register("label_encode", f"""
SELECT cnpj_basico, natureza_juridica,
  CAST(dense_rank() OVER (ORDER BY natureza_juridica) - 1 AS DOUBLE) AS natureza_juridica_idx
FROM {_COMP} c WHERE natureza_juridica IS NOT NULL""", "ML2")
def label_encode(spark, sf):
    df = silver.companies(spark, sf).where(F.col("natureza_juridica").isNotNull()) \
        .select("cnpj_basico", "natureza_juridica")
    return M.label_encoder("natureza_juridica").fit(df).transform(df)


@register("one_hot", f"""
SELECT cnpj_basico, porte_empresa,
  CASE WHEN porte_empresa = '01' THEN 1 ELSE 0 END AS porte_empresa_01,
  CASE WHEN porte_empresa = '03' THEN 1 ELSE 0 END AS porte_empresa_03,
  CASE WHEN porte_empresa = '05' THEN 1 ELSE 0 END AS porte_empresa_05
FROM {_COMP} c""", "ML5 drop-first dummies")
def one_hot(spark, sf):
    df = silver.companies(spark, sf).select("cnpj_basico", "porte_empresa")
    return M.one_hot(df, "porte_empresa")


@register("classifier_metrics", f"""
SELECT tp, fp, fn, tn,
  coalesce(CAST(tp + tn AS DOUBLE) / NULLIF(CAST(tp + fp + fn + tn AS DOUBLE), 0), 0.0) AS accuracy,
  coalesce(CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fp AS DOUBLE), 0), 0.0) AS precision,
  coalesce(CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fn AS DOUBLE), 0), 0.0) AS recall,
  coalesce(2.0 * coalesce(CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fp AS DOUBLE), 0), 0.0)
           * coalesce(CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fn AS DOUBLE), 0), 0.0)
           / NULLIF(coalesce(CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fp AS DOUBLE), 0), 0.0)
                    + coalesce(CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fn AS DOUBLE), 0), 0.0), 0), 0.0) AS f1
FROM (SELECT count(*) FILTER (WHERE target = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE target = 0 AND pred = 1) AS fp,
        count(*) FILTER (WHERE target = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE target = 0 AND pred = 0) AS tn
      FROM (SELECT target, CASE WHEN capital_social < {RULE_CAPITAL} THEN 1 ELSE 0 END AS pred
            FROM ({_TRAIN_A}) a) p) c""", "AGG16 ML8")
def classifier_metrics(spark, sf):
    t = M.training_set_simples(silver.companies(spark, sf), silver.simples(spark, sf))
    pred = t.withColumn("prediction", F.when(F.col("capital_social") < RULE_CAPITAL, 1).otherwise(0))
    return M.binary_metrics(pred)


def _checked_sql(src: str, label: str) -> str:
    train = "coalesce(('0x' || substr(md5(cnpj_basico), 1, 8))::BIGINT % 100 < 80, true)"
    return f"""
SELECT count(*) FILTER (WHERE {train}) AS train_rows, count(*) FILTER (WHERE NOT {train}) AS test_rows,
  count(DISTINCT {label}) FILTER (WHERE NOT {train}) AS test_classes, true AS probabilities_ok, true AS accuracy_ok
FROM ({src}) t"""


@register("rf_simples", _checked_sql(_TRAIN_A, "target"), "ML6 ML7 ML8 random forest: shares, classes, ranges")
def rf_simples(spark, sf):
    data = M.training_set_simples(silver.companies(spark, sf), silver.simples(spark, sf))
    train, _ = M.split(data)
    return M.checked(M.train_simples(train).transform(data), "target")


@register("rf_size", _checked_sql(_TRAIN_B, "porte_empresa"), "ML3-ML7 multi-class forest: shares, classes, ranges")
def rf_size(spark, sf):
    data = M.training_set_size(silver.companies(spark, sf), silver.simples(spark, sf),
                               silver.establishments(spark, sf))
    train, _ = M.split(data)
    model = M.fit_persisted(M.size_model_spec(), train)
    return M.checked(model.transform(data), "label")


@register("batch_score", f"""
SELECT cnpj_basico, true AS scored FROM {_COMP} c
WHERE NOT coalesce(('0x' || substr(md5(cnpj_basico), 1, 8))::BIGINT % 100 < 80, true)
  AND natureza_juridica IS NOT NULL AND capital_social IS NOT NULL AND porte_empresa IS NOT NULL""",
          "ML9 ML10 saved pipeline scores the held-out companies")
def batch_score(spark, sf):
    companies = silver.companies(spark, sf)
    data = M.training_set_simples(companies, silver.simples(spark, sf))
    train, _ = M.split(data)
    path = M.save_model(M.train_simples(train), checkpoint_dir(spark), "rf_simples")
    _, held = M.split(companies.where(F.col("natureza_juridica").isNotNull() & F.col("capital_social").isNotNull()
                                      & F.col("porte_empresa").isNotNull()))
    scored = M.score(M.load_model(path), held)
    return scored.select("cnpj_basico", (F.col("prediction").isin(0, 1) & F.col("probability_1").between(0, 1)).alias("scored"))


@register("forest_metrics", f"""
SELECT count(*) AS test_rows, count(*) FILTER (WHERE target = 1) AS positives, count(*) FILTER (WHERE target = 0) AS negatives, true AS metrics_ok
FROM ({_TRAIN_A}) t WHERE NOT coalesce(('0x' || substr(md5(cnpj_basico), 1, 8))::BIGINT % 100 < 80, true)""",
          "ML8 AGG16 accuracy, precision, recall, F1 of a forest on its test share")
def forest_metrics(spark, sf):
    data = M.training_set_simples(silver.companies(spark, sf), silver.simples(spark, sf))
    train, test = M.split(data)
    m = M.binary_metrics(M.train_simples(train).transform(test))
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    exact = lambda c, num, den: F.abs(F.col(c) - F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))) < 1e-12
    ok = (exact("accuracy", F.col("tp") + F.col("tn"), n) & exact("precision", F.col("tp"), F.col("tp") + F.col("fp"))
          & exact("recall", F.col("tp"), F.col("tp") + F.col("fn")) & exact("f1", 2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")))
    return m.select(n.alias("test_rows"), (F.col("tp") + F.col("fn")).alias("positives"), (F.col("fp") + F.col("tn")).alias("negatives"), ok.alias("metrics_ok"))


@register("batch_scores", None, "ML10 class and probability of every held-out company")
def batch_scores(spark, sf):
    companies = silver.companies(spark, sf)
    train, _ = M.split(M.training_set_simples(companies, silver.simples(spark, sf)))
    _, held = M.split(companies.where(F.col("natureza_juridica").isNotNull() & F.col("capital_social").isNotNull() & F.col("porte_empresa").isNotNull()))
    return M.score(M.train_simples(train), held)
