"""Keyed tables held in the state store of a streaming query.

The last row written for a key is kept as streaming state, so a write touches the keys of its batch
only, and a read is a scan of the last committed state: it neither merges batches nor grows with their
number. Replays change nothing, because the state belongs to the checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARRIVED = "_arrived"
#: What Spark says of a query that has committed nothing yet.
NO_BATCH = ("STDS_COMMITTED_BATCH_UNAVAILABLE", "STDS_OFFSET_LOG_UNAVAILABLE")


def last_by_key(stream: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The newest row per key as ``row``: of a later batch, then with the greater ``order``.

    Within a batch the remaining columns break ties. A batch that is replayed has its old time.
    """
    order = [c for c in order if c in stream.columns]
    rest = [c for c in stream.columns if c not in keys and c not in order]
    newest = F.max(F.struct(ARRIVED, *order, *rest)).alias("row")
    return stream.withColumn(ARRIVED, F.current_timestamp()).groupBy(*keys).agg(newest)


def read_state(spark: SparkSession, checkpoint: str, schema: T.StructType) -> DataFrame:
    """The rows that :func:`last_by_key` holds; none before the first batch is committed."""
    try:
        state = spark.read.format("statestore").load(checkpoint)
    except PySparkException as error:
        if error.getCondition() not in NO_BATCH:
            raise
        return spark.createDataFrame([], schema)
    return state.select("key.*", "value.max.*").select(*schema.names)
