"""Labelled rasters: profile, class balance, samples and augmentation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.rasters import (
    CLASS_NAMES,
    class_name,
    flip_horizontal,
    seeded_unit,
    shift,
)


def dataset_profile(images: DataFrame, pixels: str = "pixels") -> DataFrame:
    """Rows, array sizes and value range in one pass."""
    element = images.schema[pixels].dataType.elementType.simpleString()
    return images.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(F.size(pixels)).cast("bigint").alias("min_size"),
        F.max(F.size(pixels)).cast("bigint").alias("max_size"),
        F.min(F.array_min(pixels)).alias("min_value"),
        F.max(F.array_max(pixels)).alias("max_value"),
        F.lit(element).alias("dtype"),
    )


def class_distribution(images: DataFrame, names: Sequence[str] = CLASS_NAMES) -> DataFrame:
    counts = images.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("class_name", class_name(F.col("label"), names))


def class_weights(images: DataFrame) -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    counts = images.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("classes")).first()
    total, classes = whole["total"] or 0, whole["classes"]
    return counts.withColumn("weight", F.lit(float(total)) / (F.lit(float(classes)) * F.col("n")))


def first_samples(images: DataFrame, n: int = 25) -> DataFrame:
    return images.orderBy("id").limit(n)


def random_flip(
    images: DataFrame, height: int, width: int, channels: int, seed: int = 42
) -> DataFrame:
    """Mirror about half of the pictures; which ones depends on id and seed only."""
    flipped = flip_horizontal(F.col("pixels"), height, width, channels)
    chosen = seeded_unit(F.col("id"), seed, "flip") < 0.5
    return images.withColumn("pixels", F.when(chosen, flipped).otherwise(F.col("pixels")))


def random_shift(
    images: DataFrame,
    height: int,
    width: int,
    channels: int,
    factor: float = 0.05,
    seed: int = 42,
) -> DataFrame:
    """Move each picture by up to ``factor`` of its size per axis, filling from the nearest edge."""
    def offset(size: int, purpose: str):
        unit = seeded_unit(F.col("id"), seed, purpose)
        return (unit * 2 - 1) * F.lit(factor * size)

    moved = shift(
        F.col("pixels"), F.col("_dy"), F.col("_dx"), height, width, channels
    )
    return (
        images.withColumn("_dy", offset(height, "dy"))
        .withColumn("_dx", offset(width, "dx"))
        .withColumn("pixels", moved)
        .drop("_dy", "_dx")
    )
