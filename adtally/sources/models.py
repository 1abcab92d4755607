"""Training rows and saved models."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession


def read_libsvm(spark: SparkSession, path: str, features: int | None = None) -> DataFrame:
    """Columns label and features; giving the feature count saves a scan of the files."""
    reader = spark.read.format("libsvm")
    if features is not None:
        reader = reader.option("numFeatures", features)
    return reader.load(path)


def load_model(path: str) -> LogisticRegressionModel:
    return LogisticRegressionModel.load(path)
