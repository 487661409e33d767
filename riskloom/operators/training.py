"""Classifier heads on frozen feature vectors, compared on validation rows."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.rasters import argmax
from riskloom.operators.evaluation import test_metrics


def candidate_heads(width: int, classes: int, seed: int = 42) -> dict:
    """A linear head and one with a hidden layer."""
    common = {"featuresCol": "features", "labelCol": "label"}
    return {
        "linear head": LogisticRegression(maxIter=10, regParam=0.01, **common),
        "hidden-layer head": MultilayerPerceptronClassifier(
            layers=[width, 32, classes], maxIter=15, seed=seed, **common
        ),
    }


def as_features(df: DataFrame) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col("vector").cast("array<double>")))


def predict(model: Transformer, df: DataFrame, name: str) -> DataFrame:
    """Class probabilities and the most probable class."""
    scored = model.transform(as_features(df)).withColumn(
        "probabilities", vector_to_array("probability")
    )
    return scored.select(
        F.lit(name).alias("model"),
        "id",
        "label",
        argmax(F.col("probabilities")).alias("prediction"),
        "probabilities",
    )


def train_heads(train: DataFrame, heads: dict) -> dict[str, Transformer]:
    rows = as_features(train).select("features", F.col("label").cast("double")).persist()
    try:
        return {name: head.fit(rows) for name, head in heads.items()}
    finally:
        rows.unpersist()


def best_on_validation(models: dict[str, Transformer], validation: DataFrame) -> str:
    """Name of the model with the smallest validation loss."""
    losses = {
        name: test_metrics(predict(model, validation, name)).first()["test_loss"]
        for name, model in models.items()
    }
    return min(losses, key=lambda name: (losses[name], name))
