"""Two small MLlib models and a registry that stores them by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def fit_naive_bayes(train: DataFrame, features: Sequence[str], label: str) -> PipelineModel:
    """Gaussian naive Bayes on numeric features and a text label."""
    return Pipeline(
        stages=[
            StringIndexer(inputCol=label, outputCol="__label", stringOrderType="alphabetAsc"),
            VectorAssembler(inputCols=list(features), outputCol="__features"),
            NaiveBayes(modelType="gaussian", labelCol="__label", featuresCol="__features", predictionCol="__class"),
        ]
    ).fit(train)


def predict_label(model: PipelineModel, df: DataFrame, out: str = "predicted") -> DataFrame:
    """Add the predicted label's text."""
    labels = model.stages[0].labels
    names = F.array(*[F.lit(x) for x in labels])
    return model.transform(df).select(*df.columns, F.element_at(names, (F.col("__class") + 1).cast("int")).alias(out))


def fit_linear(train: DataFrame, numeric: Sequence[str], category: str, target: str) -> PipelineModel:
    """Linear regression with one categorical regressor (one-hot, intercept kept)."""
    return Pipeline(
        stages=[
            StringIndexer(inputCol=category, outputCol="__cat", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCol="__cat", outputCol="__hot"),
            VectorAssembler(inputCols=[*numeric, "__hot"], outputCol="__features"),
            LinearRegression(featuresCol="__features", labelCol=target, predictionCol="__value", solver="normal"),
        ]
    ).fit(train)


def predict_value(model: PipelineModel, df: DataFrame, out: str = "predicted") -> DataFrame:
    return model.transform(df).select(*df.columns, F.col("__value").alias(out))


def save_model(spark: SparkSession, model: PipelineModel, root: str, name: str, version: int) -> str:
    """Save under the registry's folder and add a registry row."""
    path = f"{root}/models/{name}/v={version}"
    model.write().save(path)
    row = spark.range(1).select(
        F.lit(name).alias("name"), F.lit(version).cast("int").alias("version"), F.lit(path).alias("path")
    )
    row.write.mode("append").parquet(f"{root}/registry")
    return path


def load_model(spark: SparkSession, root: str, name: str) -> PipelineModel:
    """The latest version registered under ``name``."""
    rows = spark.read.parquet(f"{root}/registry").filter(F.col("name") == name)
    path = rows.agg(F.max_by("path", "version")).first()[0]
    if path is None:
        raise KeyError(name)
    return PipelineModel.load(path)
