"""Places of regular-expression matches as array columns, from Spark's own functions.

Splitting a text at a pattern gives what lies between the matches, extracting gives the matches;
both walk the text in the same way, so adding up their sizes gives every match's place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_MATCHES = "array<struct<start: int, end: int, hit: string, before: string, after: string>>"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, as the only element of an array."""
    return F.transform(F.array(value), use)[0]


def _appended(found: Column, new: Column) -> Column:
    return F.concat(found, F.array(new))


def located(
    between: Column, hits: Column, size: Callable[[Column], Column] = F.length, context: int = 0
) -> Column:
    """Structs (start, end, hit, before, after); ``context`` characters around each match are kept.

    A fold copies what it has found so far at each step, so the matches are folded in blocks of about
    as many as there are blocks; the blocks are then moved to where they begin.
    """
    pairs = F.arrays_zip(
        F.slice(between, 1, F.size(hits)).alias("gap"),
        hits.alias("hit"),
        F.slice(between, 2, F.size(hits)).alias("next"),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(NO_MATCHES).alias("found"))

    def step(done: Column, pair: Column) -> Column:
        gap, hit, following = pair["gap"], pair["hit"], pair["next"]
        first = done["at"] + size(gap)
        last = first + size(hit)
        found = F.struct(
            first.alias("start"),
            last.alias("end"),
            hit.alias("hit"),
            F.right(gap, F.lit(context)).alias("before"),
            F.left(following, F.lit(context)).alias("after"),
        )
        return F.struct(last.alias("at"), _appended(done["found"], found).alias("found"))

    def in_blocks(all_pairs: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(all_pairs))).cast("int")
        heads = F.when(F.size(all_pairs) > 0, F.sequence(F.lit(1), F.size(all_pairs), width)).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(heads, lambda head: F.aggregate(F.slice(all_pairs, head, width), start, step))

    def moved(blocks: Column) -> Column:
        places = F.aggregate(
            blocks,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("places")),
            lambda done, block: F.struct(
                (done["at"] + block["at"]).alias("at"), _appended(done["places"], done["at"]).alias("places")
            ),
            lambda done: done["places"],
        )
        return F.flatten(
            F.zip_with(
                blocks, places,
                lambda block, place: F.transform(
                    block["found"],
                    lambda m: F.struct(
                        (m["start"] + place).alias("start"), (m["end"] + place).alias("end"),
                        m["hit"].alias("hit"), m["before"].alias("before"), m["after"].alias("after"),
                    ),
                ),
            )
        )

    return _bound(pairs, lambda all_pairs: _bound(in_blocks(all_pairs), moved))
