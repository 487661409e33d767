"""Batch report of the rows a watermark would drop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.joins import lookup_join
from riskloom.operators.running import running


def late_rows(
    events: DataFrame,
    batch: str,
    event_time: str,
    delay: str,
    block: int = 1000,
) -> DataFrame:
    """Rows per arrival batch that lie behind the watermark reached by the earlier batches.

    ``batch`` numbers the arrival batches. The watermark of a batch is the greatest event time of
    all earlier batches minus ``delay``.
    """
    tops = events.groupBy(batch).agg(F.max(event_time).alias("_top"))
    marks = running(
        tops, [], batch, F.col("_top"), block, F.max, F.greatest,
        include_current=False, alias="_seen",
    ).select(batch, (F.col("_seen") - F.expr(f"INTERVAL {delay}")).alias("watermark"))
    late = F.col(event_time) < F.col("watermark")
    return (
        lookup_join(events.select(batch, event_time), marks, [batch])
        .groupBy(batch, "watermark")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(late).alias("n_late"))
    )
