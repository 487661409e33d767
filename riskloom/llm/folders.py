"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskloom.session import new_folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back, so that no later step computes it anew."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
