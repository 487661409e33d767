"""Joins with a table that has one row per key, safe against size and skew.

A side is broadcast only after its size was measured. Beyond the limit the join shuffles, and the
keys that carry a large share of the rows are taken out of the shuffle: fewer than ``HOT_KEYS``
keys can each hold more than one ``HOT_KEYS``-th of the rows, so their part of the lookup table is
small by arithmetic and is broadcast instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 << 20
HOT_KEYS = 10_000
MIN_HOT_ROWS = 1_000_000
STREAM_SALTS = 64


def _width(field: T.StructField) -> Column:
    """Bytes of one value."""
    name = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(name), F.lit(0)) + 16
    if isinstance(field.dataType, T.ArrayType) and not isinstance(
        field.dataType.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType)
    ):
        return F.greatest(F.size(name), F.lit(0)) * 8 + 16
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0)) * 2
    return F.lit(16)


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows in memory, counted by one aggregation."""
    width = F.lit(16)
    for field in df.schema.fields:
        width = width + _width(field)
    return df.agg(F.coalesce(F.sum(width.cast("bigint")), F.lit(0))).first()[0]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``fact`` with ``dim``, which has at most one row per key.

    ``how`` is inner, left, left_semi or left_anti.
    """
    on = list(on)
    if fits_broadcast(dim, limit):
        return fact.join(F.broadcast(dim), on, how)
    if fact.isStreaming:
        return _salted_join(fact, dim, on, how)
    return hot_split_join(fact, dim, on, how)


def hot_keys(
    counts: DataFrame, on: Sequence[str], n_rows: int | None, min_hot_rows: int = MIN_HOT_ROWS
) -> DataFrame | None:
    """The keys that hold more than one ``HOT_KEYS``-th of the rows, marked for broadcast."""
    on = list(on)
    total = n_rows or counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    threshold = max(total // HOT_KEYS, min_hot_rows)
    if total <= threshold:
        return None
    keys = counts.filter(F.col("n") > threshold).dropna(subset=on).select(*on)
    found = keys.collect()
    return F.broadcast(counts.sparkSession.createDataFrame(found, keys.schema)) if found else None


def hot_split_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    counts: DataFrame | None = None,
    n_rows: int | None = None,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Shuffle join in which hot keys are joined by broadcast.

    ``counts`` (key columns and ``n``) and ``n_rows`` may supply the rows per key and in all where
    they are known already.
    """
    on = list(on)
    if n_rows is not None and n_rows <= min_hot_rows:
        return fact.join(dim, on, how)
    if counts is None:
        counts = fact.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select(*on, "n")
    hot = hot_keys(counts, on, n_rows, min_hot_rows)
    if hot is None:
        return fact.join(dim, on, how)
    hot_dim = F.broadcast(dim.join(hot, on, "left_semi"))
    hot_part = fact.join(hot, on, "left_semi").join(hot_dim, on, how)
    cold_part = fact.join(hot, on, "left_anti").join(dim, on, how)
    return hot_part.unionByName(cold_part)


def _salted_join(fact: DataFrame, dim: DataFrame, on: list[str], how: str) -> DataFrame:
    """For a stream, whose key counts are unknown: spread each key over several partitions."""
    # Seeded, hence the same when a task is run again; identical rows get different salts.
    salt = F.floor(F.rand(17) * STREAM_SALTS).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(STREAM_SALTS - 1))).alias("_salt")
    return (
        fact.withColumn("_salt", salt)
        .join(dim.select("*", copies), [*on, "_salt"], how)
        .drop("_salt")
    )
