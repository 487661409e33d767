"""Running aggregates over an ordered key without holding a whole group in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _truncated(number: int, width: int) -> int:
    return abs(number) // width * (1 if number >= 0 else -1)


def _levels(low: int, high: int, block: int) -> int:
    """How many times blocks are gathered into blocks until one holds all numbers, truncated as in ``div``."""
    n, width = 0, block
    while _truncated(low, width) != _truncated(high, width):
        n, width = n + 1, width * block
    return n


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: Column,
    block: int,
    combine: Callable[[Column], Column] = F.sum,
    merge: Callable[[Column, Column], Column] = lambda a, b: a + b,
    descending: bool = False,
    include_current: bool = True,
    alias: str = "running",
    ties: Sequence[Column] = (),
) -> DataFrame:
    """``combine(value)`` over all rows of the same keys up to the current one.

    Rows are cut into blocks of ``block`` consecutive numbers of the integer column ``order``, blocks
    into blocks of blocks, and so on until one holds all numbers, however sparse. A window runs over
    the rows of each block, others over the totals of at most ``2 * block`` blocks of each level;
    what lies before is added up from the top. So a key of any size, or no key at all, is spread over
    as many tasks as it has blocks. Rows whose keys and order are the same stand in the order of
    ``ties``; they are one task's work. A null order comes first, or last if ``descending``.
    """
    keys, direction, block = list(keys), F.desc if descending else F.asc, max(block, 2)
    start = Window.unboundedPreceding
    low, high = df.agg(F.min(order), F.max(order)).first()
    # A null is the number before all others.
    low = (low or 0) - 1
    n_levels = _levels(low, high or 0, block)
    number = F.coalesce(F.col(order).cast("long"), F.lit(low).cast("long"))
    rows = df.withColumn("_value", value).withColumn("_block0", number)
    rows = rows.withColumn("_block0", F.expr(f"_block0 div {block}L"))
    stop = Window.currentRow if include_current else -1
    inner = Window.partitionBy(*keys, "_block0").orderBy(direction(order), *ties).rowsBetween(start, stop)
    inside = rows.withColumn("_inside", combine("_value").over(inner))
    if not n_levels:
        return inside.withColumn(alias, F.col("_inside")).select(*df.columns, alias)

    # Totals of the blocks of each level, and what lies before each within its own block.
    totals = [rows.groupBy(*keys, "_block0").agg(combine("_value").alias("_total"))]
    for n in range(1, n_levels + 1):
        up = F.expr(f"_block{n - 1} div {block}L").alias(f"_block{n}")
        totals[-1] = totals[-1].select("*", up)
        if n < n_levels:
            totals.append(totals[-1].groupBy(*keys, f"_block{n}").agg(combine("_total").alias("_total")))
    before = None
    for n in range(n_levels - 1, -1, -1):
        siblings = Window.partitionBy(*keys, f"_block{n + 1}").orderBy(direction(f"_block{n}")).rowsBetween(start, -1)
        own = totals[n].withColumn("_before", combine("_total").over(siblings)).drop("_total")
        if before is not None:
            above = before.select(*keys, f"_block{n + 1}", F.col("_before").alias("_above"))
            own = _joined(own, above, [*keys, f"_block{n + 1}"])
            own = own.withColumn("_before", F.coalesce(merge(F.col("_above"), F.col("_before")), "_above", "_before"))
        before = own.select(*keys, f"_block{n}", "_before")
    merged = F.coalesce(merge(F.col("_before"), F.col("_inside")), "_before", "_inside")
    return _joined(inside, before, [*keys, "_block0"]).withColumn(alias, merged).select(*df.columns, alias)


def _joined(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Null-safe inner join that keeps the columns of ``on`` once: rows without a key keep their group."""
    right = right.select(*[F.col(c).alias(f"_key_{c}") if c in on else F.col(c) for c in right.columns])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in on])
    return left.join(right, same).drop(*[f"_key_{c}" for c in on])
