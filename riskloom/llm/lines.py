"""Removal of lines that many documents share.

Every document's distinct line keys are hashed and shuffled without their text; a hash is frequent
when it has at least ``min_docs`` documents. The lines to drop go back to their documents as
positions, and each text is put together again from the positions that stay.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.folders import staged
from riskloom.llm.memory import lean
from riskloom.operators.joins import lookup_join

NULL_ID = -(1 << 63)
#: White space that is stripped from a line for its key.
BLANKS = b" \t\n\x0b\x0c\r"
LEAST_POINTS = 10
#: Shared lines that are broadcast; more are joined by a shuffle without the most frequent of them.
LOOKUP_BYTES = 16 << 20


def line_keys(raw: bytes) -> list[bytes]:
    return [line.strip(BLANKS) for line in raw.lower().split(b"\n")]


def _points(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode())


def _hashed(docs: DataFrame, least_points: int) -> DataFrame:
    """One row per document and distinct key that is long enough: its 128-bit hash and positions."""

    def run(batches):
        for batch in batches:
            for doc_id, mark, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                places: dict[bytes, list[int]] = {}
                for at, key in enumerate(line_keys(raw or b"")):
                    if len(key) >= least_points and _points(key) >= least_points:
                        places.setdefault(key, []).append(at)
                if places:
                    prints = [xxhash.xxh3_128_digest(key) for key in places]
                    halves = [
                        [int.from_bytes(p[i : i + 8], "little", signed=True) for p in prints]
                        for i in (0, 8)
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(halves[0], pa.int64()),
                            pa.array(halves[1], pa.int64()),
                            pa.array([doc_id] * len(prints), pa.int64()),
                            pa.array([mark] * len(prints), pa.int64()),
                            pa.array(list(places.values()), pa.list_(pa.int32())),
                        ],
                        ["high", "low", "doc_id", "mark", "places"],
                    )

    return docs.mapInArrow(lean(run), "high long, low long, doc_id long, mark long, places array<int>")


def drop_shared_lines(
    documents: DataFrame, least_points: int = LEAST_POINTS, min_docs: int = 2
) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): ``n_lines``, ``n_dropped``, ``kept`` text.

    The key of a line is the line without blanks at its ends, A-Z lower-cased. Lines whose key has
    at least ``least_points`` code points and stands in at least ``min_docs`` documents are dropped,
    except in the smallest doc_id that holds it. A null or empty text is one empty line. A null
    doc_id is an id below all others. Rows that repeat a doc_id are one document as to counting,
    and each of them is treated. Other columns are ignored.
    """
    docs = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("mark", F.xxhash64("text"))
    # Written once: the lines are counted, and the shared ones are looked up.
    lines = staged(_hashed(docs.select("doc_id", "mark", F.col("text").cast("binary")), least_points), "lines")
    shared = lines.groupBy("high", "low").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    if min_docs == 2:
        shared = shared.filter("first < last")
    else:
        counts = lines.select("high", "low", "doc_id").distinct().groupBy("high", "low").count()
        shared = shared.join(counts.filter(F.col("count") >= min_docs), ["high", "low"])
    shared = staged(shared.select("high", "low", "first"), "shared-lines")
    drops = (
        # A line that very many documents hold stays spread.
        lookup_join(lines, shared, ["high", "low"], "inner", LOOKUP_BYTES)
        .filter("doc_id > first")
        .groupBy("doc_id", "mark")
        .agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))
    )

    def rebuild(batches):
        for batch in batches:
            kept, n_lines, n_dropped = [], [], []
            for text, places in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                rows = text.split("\n")
                gone = set(places or ())
                kept.append("\n".join(x for i, x in enumerate(rows) if i not in gone) if gone else text)
                n_lines.append(len(rows))
                n_dropped.append(len(gone))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_lines, pa.int64()),
                    pa.array(n_dropped, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                ["doc_id", "n_lines", "n_dropped", "kept"],
            )

    return (
        docs.join(drops, ["doc_id", "mark"], "left")
        .select("doc_id", "text", "places")
        .mapInArrow(lean(rebuild), "doc_id long, n_lines long, n_dropped long, kept string")
        .withColumn("doc_id", F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")))
    )
