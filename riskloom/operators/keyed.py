"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the row with the greatest ``order`` per key.

    An aggregation rather than a window: copies of a key are reduced before the shuffle, however
    many there are. Remaining columns break ties, so the result does not depend on arrival.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = F.max(F.struct(*order, *rest)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def unseen(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``seen``."""
    return df.join(seen.select(key).distinct(), key, "left_anti")
