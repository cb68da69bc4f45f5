"""Classifier training and batch scoring on registry features (Spark MLlib).

Training sets are joins expressed as DataFrames; encoders live inside the
saved ``PipelineModel`` so scoring applies exactly the training encodings.
Metrics are computed as one distributed aggregate of confusion counts.
"""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiflow.functions.numbers import coerce_number
from regiflow.schema import SIZE_CLASSES

SEED = 42
TRAIN_PCT = 80


# --- training sets ------------------------------------------------------------

def training_set_simples(companies: DataFrame, simples: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Features (natureza, capital, porte) + target 1 when opted into Simples.

    ``max_rows`` reproduces the reference cap deterministically (hash order);
    by default the whole join is used.
    """
    s = simples.where(F.col("opcao_pelo_simples").isin("S", "N")).select("cnpj_basico", "opcao_pelo_simples")
    df = (companies.select("cnpj_basico", "natureza_juridica", "capital_social", "porte_empresa")
          .join(s, "cnpj_basico", "inner")
          .na.drop()
          .withColumn("target", F.when(F.col("opcao_pelo_simples") == "S", 1).otherwise(0)))
    return _cap(df, max_rows)


def training_set_size(companies: DataFrame, simples: DataFrame, establishments: DataFrame,
                      max_rows: int | None = None) -> DataFrame:
    """Features for the company-size classifier (head-office establishments only).

    The filter on the establishment side makes the second outer join an inner
    join; Catalyst pushes it into that scan.
    """
    head = (establishments.where(F.col("identificador_matriz_filial").try_cast("int") == 1)
            .select("cnpj_basico", "cnae_fiscal_principal"))
    df = (companies.where(F.col("porte_empresa").isNotNull() & (F.col("porte_empresa") != ""))
          .select("cnpj_basico", "capital_social", "natureza_juridica", "porte_empresa")
          .join(simples.select("cnpj_basico", "opcao_pelo_simples"), "cnpj_basico", "left")
          .join(head, "cnpj_basico", "inner")
          .where(F.col("porte_empresa").isin(SIZE_CLASSES))
          .withColumn("opcao_pelo_simples", F.coalesce(F.col("opcao_pelo_simples"), F.lit("N")))
          .withColumn("capital_social", coerce_number(F.col("capital_social"), 0.0)))
    return _cap(df, max_rows)


def _cap(df: DataFrame, max_rows: int | None) -> DataFrame:
    if max_rows is None:
        return df
    return df.orderBy(F.xxhash64("cnpj_basico"), "cnpj_basico").limit(max_rows)


def split(df: DataFrame, key: str = "cnpj_basico", train_pct: int = TRAIN_PCT) -> tuple[DataFrame, DataFrame]:
    """Reproducible train/test split by key hash (independent of partitioning)."""
    return df.where(is_train(key, train_pct)), df.where(~is_train(key, train_pct))


def is_train(key: str = "cnpj_basico", train_pct: int = TRAIN_PCT) -> Column:
    """True for the training share: the first 32 bits of the key's md5, modulo 100 (a null key trains)."""
    bucket = F.conv(F.substring(F.md5(F.col(key).cast("binary")), 1, 8), 16, 10).cast("bigint") % 100
    return F.coalesce(bucket < train_pct, F.lit(True))


def checked(pred: DataFrame, label: str) -> DataFrame:
    """One row on predictions of all rows: sizes of both shares, classes met in the test share,
    whether every probability lies within 0..1, and whether the model has learned its
    training share at least as well as the most frequent class would."""
    from pyspark.ml.functions import vector_to_array
    x = pred.select(is_train().alias("t"), F.col(label).alias("y"), (F.col(label) == F.col("prediction")).alias("hit"),
                    vector_to_array("probability").alias("q"))
    by = x.groupBy("t", "y").agg(F.count(F.lit(1)).alias("n"), F.count_if("hit").alias("hits"),
                                 F.bool_and(F.forall("q", lambda v: (v >= 0) & (v <= 1))).alias("q"))
    of = lambda c, test=False: F.when(~F.col("t") if test else F.col("t"), F.col(c))
    rows = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return by.agg(rows(of("n")).alias("train_rows"), rows(of("n", True)).alias("test_rows"),
                  F.count_distinct(of("y", True)).alias("test_classes"), F.bool_and("q").alias("probabilities_ok"),
                  F.coalesce(F.sum(of("hits")) >= F.max(of("n")), F.lit(False)).alias("accuracy_ok"))


# --- encoders -----------------------------------------------------------------

def label_encoder(col: str, out: str | None = None) -> StringIndexer:
    """Sorted distinct values -> 0..n-1 (alphabetical, like a label encoder)."""
    return StringIndexer(inputCol=col, outputCol=out or f"{col}_idx", stringOrderType="alphabetAsc",
                         handleInvalid="keep")


def category_values(df: DataFrame, col: str) -> list[str]:
    """Sorted distinct non-null values: the columns of the wide form, which has one per value.

    For a column of very many values use ``dummy_encoder``, a sparse vector of any length.
    """
    vals = df.where(F.col(col).isNotNull()).select(F.col(col).cast("string").alias("v")).distinct().orderBy("v")
    return [r["v"] for r in vals.collect()]


def dummy_encoder(col: str) -> list:
    """Stages that turn a column into a sparse 0/1 vector ``{col}_dummies`` without its first value."""
    return [StringIndexer(inputCol=col, outputCol=f"{col}_code", stringOrderType="alphabetDesc", handleInvalid="keep"),
            # in descending order the first value is the last category but the one for unknown values
            OneHotEncoder(inputCol=f"{col}_code", outputCol=f"{col}_dummies", dropLast=True)]


def one_hot_columns(col: str, values: list[str], drop_first: bool = True) -> dict[str, Column]:
    """0/1 dummy columns ``{col}_{value}``; the first category is dropped; null -> all 0."""
    keep = values[1:] if drop_first else values
    return {f"{col}_{v}": F.when(F.col(col) == v, F.lit(1)).otherwise(F.lit(0)) for v in keep}


def one_hot(df: DataFrame, col: str, values: list[str] | None = None, drop_first: bool = True) -> DataFrame:
    return df.withColumns(one_hot_columns(col, values or category_values(df, col), drop_first))


# --- models -------------------------------------------------------------------

def forest(label: str, features: str = "features", max_bins: int = 32) -> RandomForestClassifier:
    """100 trees of depth 10, seed 42 (reference parameters).

    ``maxMemoryInMB`` lets each pass over the data grow more nodes at once
    (fewer passes per tree level) and ``cacheNodeIds`` avoids re-walking the
    trees for every row at deep levels; neither changes the model family.
    """
    return RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=100, maxDepth=10, seed=SEED,
                                  maxBins=max_bins, maxMemoryInMB=1024, cacheNodeIds=True)


def fit_persisted(spec: Pipeline, train: DataFrame) -> PipelineModel:
    """Fit with the training rows persisted for the duration of the fit.

    The encoders and every tree level read the input again; persisting keeps
    the joins that build it from being recomputed each time (lost blocks are
    recomputed from lineage, so executor loss is survivable).  Each pass runs
    one task per partition, and AQE coalesces a small join's output down to a
    few partitions, so the narrow feature rows are first spread to as many
    partitions as a shuffle has, one per core at least.
    """
    from pyspark import StorageLevel
    spark = train.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cached = train.repartition(parts).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return spec.fit(cached)
    finally:
        cached.unpersist()


def simples_model_spec() -> Pipeline:
    """Codes are compared as numbers, like label-encoded columns, so there is no limit on their number."""
    return Pipeline(stages=[
        label_encoder("natureza_juridica"), label_encoder("porte_empresa"),
        SQLTransformer(statement="SELECT *, natureza_juridica_idx + 0.0D AS natureza_number, porte_empresa_idx + 0.0D AS porte_number FROM __THIS__"),
        VectorAssembler(inputCols=["natureza_number", "capital_social", "porte_number"], outputCol="features"),
        forest("target")])


def size_model_spec(categories: tuple[str, ...] = ("natureza_juridica", "opcao_pelo_simples")) -> Pipeline:
    return Pipeline(stages=[
        StringIndexer(inputCol="porte_empresa", outputCol="label", stringOrderType="alphabetAsc"),
        *[stage for c in categories for stage in dummy_encoder(c)],
        VectorAssembler(inputCols=["capital_social", *[f"{c}_dummies" for c in categories]], outputCol="features"),
        forest("label")])


def binary_metrics(pred: DataFrame, label: str = "target", prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall, F1 from one aggregate (zero division -> 0)."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    c = pred.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                 F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    prec = F.coalesce(F.try_divide(tp.cast("double"), (tp + fp).cast("double")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(tp.cast("double"), (tp + fn).cast("double")), F.lit(0.0))
    return (c.withColumn("accuracy", F.coalesce(F.try_divide((tp + tn).cast("double"),
                                                             (tp + fp + fn + tn).cast("double")), F.lit(0.0)))
            .withColumn("precision", prec).withColumn("recall", rec)
            .withColumn("f1", F.coalesce(F.try_divide(F.lit(2.0) * F.col("precision") * F.col("recall"),
                                                      F.col("precision") + F.col("recall")), F.lit(0.0))))


def multiclass_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and macro F1 of a multi-class prediction (grouped aggregates)."""
    per_class = (pred.select(F.col(label).alias("y"), F.col(prediction).alias("p"))
                 .select(F.explode(F.array(F.struct(F.col("y").alias("k"), F.lit(1).alias("is_y"),
                                                    (F.col("y") == F.col("p")).cast("int").alias("hit"),
                                                    F.lit(0).alias("is_p")),
                                           F.struct(F.col("p").alias("k"), F.lit(0).alias("is_y"), F.lit(0).alias("hit"),
                                                    F.lit(1).alias("is_p")))).alias("e"))
                 .groupBy("e.k").agg(F.sum("e.is_y").alias("support"), F.sum("e.hit").alias("tp"),
                                     F.sum("e.is_p").alias("predicted")))
    f1 = F.coalesce(F.try_divide(F.lit(2.0) * F.col("tp"), (F.col("support") + F.col("predicted")).cast("double")),
                    F.lit(0.0))
    return per_class.agg(F.try_divide(F.sum("tp").cast("double"), F.sum("support").cast("double")).alias("accuracy"),
                         F.avg(f1).alias("macro_f1"), F.sum("support").cast("bigint").alias("test_rows"))


def train_simples(train: DataFrame) -> PipelineModel:
    return fit_persisted(simples_model_spec(), train)


def save_model(model: PipelineModel, base_dir: str, name: str) -> str:
    path = f"{base_dir.rstrip('/')}/models/{name}-{uuid.uuid4().hex[:12]}"
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def log_run(metrics: DataFrame, params: dict, path: str) -> None:
    """Append a run row (params + metrics) to a Parquet run table."""
    row = metrics.withColumns({k: F.lit(str(v)) for k, v in params.items()}).withColumn("run_at", F.current_timestamp())
    row.write.mode("append").parquet(path)


def score(model: PipelineModel, df: DataFrame, key: str = "cnpj_basico") -> DataFrame:
    """Batch scoring: key, predicted class and probability of class 1."""
    from pyspark.ml.functions import vector_to_array
    out = model.transform(df)
    return out.select(key, F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability")[1].alias("probability_1"))
