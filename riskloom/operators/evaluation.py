"""Classifier evaluation from prediction rows (``label``, ``prediction``, ``probabilities``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: probabilities are clipped here before the logarithm.
EPSILON = 1e-7


def pair_counts(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(predictions: DataFrame, classes: Sequence[int]) -> DataFrame:
    """One row per class, one column per predicted class: the full square of ``classes``.

    ``predicted_other`` counts predictions outside of ``classes``; a label outside of them gets a
    row of its own, so the cells add up to the number of rows.
    """
    cells = [
        F.count_if(F.col("prediction") == c).alias(f"predicted_{c}") for c in classes
    ]
    known = F.coalesce(F.col("prediction").isin(*classes), F.lit(False))
    counts = predictions.groupBy("label").agg(*cells, F.count_if(~known).alias("predicted_other"))
    names = counts.columns[1:]
    label = counts.schema["label"].dataType
    listed = predictions.sparkSession.createDataFrame([(c,) for c in classes], "label int")
    square = listed.select(F.col("label").cast(label)).distinct()
    return square.unionByName(counts.select("label")).distinct().join(
        counts.withColumnRenamed("label", "_label"), F.col("label").eqNullSafe(F.col("_label")), "left"
    ).select("label", *[F.coalesce(n, F.lit(0)).alias(n) for n in names])


def _ratio(part: Column, whole: Column) -> Column:
    """0 where the denominator is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def classification_report(predictions: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and both averages.

    The rows are counted once per (label, prediction); all else works on those few counts.
    """
    sides = F.array(
        F.struct(
            F.col("label").alias("class"),
            F.col("n").alias("support"),
            F.lit(0).cast("bigint").alias("predicted"),
            F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hits"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            F.lit(0).cast("bigint").alias("support"),
            F.col("n").alias("predicted"),
            F.lit(0).cast("bigint").alias("hits"),
        ),
    )
    per_class = (
        pair_counts(predictions)
        .select(F.explode(sides).alias("s"))
        .groupBy("s.class")
        .agg(
            F.sum("s.support").alias("support"),
            F.sum("s.predicted").alias("predicted"),
            F.sum("s.hits").alias("hits"),
        )
        .withColumn("precision", _ratio(F.col("hits"), F.col("predicted")))
        .withColumn("recall", _ratio(F.col("hits"), F.col("support")))
        .withColumn("f1_score", _ratio(2 * F.col("hits"), F.col("support") + F.col("predicted")))
    )

    def row(name: Column, weight: Column) -> Column:
        return F.struct(name.alias("name"), weight.cast("double").alias("weight"))

    rows = F.array(
        row(F.col("class").cast("string"), F.lit(1)),
        row(F.lit("accuracy"), F.lit(1)),
        row(F.lit("macro avg"), F.lit(1)),
        row(F.lit("weighted avg"), F.col("support")),
    )
    accuracy = _ratio(F.sum("hits"), F.sum("support"))

    def mean(metric: str) -> Column:
        weighted = _ratio(F.sum(F.col(metric) * F.col("r.weight")), F.sum("r.weight"))
        return F.when(F.col("r.name") == "accuracy", accuracy).otherwise(weighted).alias(metric)

    return (
        per_class.withColumn("r", F.explode(rows))
        .groupBy("r.name")
        .agg(mean("precision"), mean("recall"), mean("f1_score"), F.sum("support").alias("support"))
        .withColumnRenamed("name", "class")
    )


def test_metrics(predictions: DataFrame, *keys: str) -> DataFrame:
    """Mean cross-entropy and accuracy, per ``keys`` if given."""
    chosen = F.get(F.col("probabilities"), F.col("label").cast("int"))
    clipped = F.least(F.greatest(chosen, F.lit(EPSILON)), F.lit(1 - EPSILON))
    right = (F.col("label") == F.col("prediction")).cast("double")
    return predictions.groupBy(*keys).agg(
        F.avg(-F.log(clipped)).alias("test_loss"),
        F.avg(right).alias("test_accuracy"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def model_comparison(predictions: DataFrame) -> DataFrame:
    """One row per ``model``; the rows of all models are read in one pass."""
    return test_metrics(predictions, "model").withColumnRenamed("model", "modelo")
