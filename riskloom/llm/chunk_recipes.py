"""Exact deduplication by content-defined chunks.

A text is cut where a rolling hash of its last ``WINDOW`` bytes meets a condition, so equal
passages give equal chunks wherever they stand. A chunk is known by a 64-bit key; the key counts
as verified when the SHA-256 of every chunk that has it agrees, otherwise its chunks are told
apart by that digest. A document is then an ordered list of chunk identifiers, its recipe, and
equal texts are equal recipes. Only identifiers and digests are shuffled, never texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import texts
from riskloom.llm.folders import staged
from riskloom.llm.memory import lean
from riskloom.operators.joins import lookup_join

WINDOW = 48
MEAN_BYTES = 2048
LEAST_BYTES = 256
MOST_BYTES = 16384
NULL_ID = -(1 << 63)
#: Groups of copies that are broadcast; more are joined by a shuffle without the largest of them.
LOOKUP_BYTES = 16 << 20


def cuts(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """End of every chunk of each text, relative to ``data``; an empty text has one empty chunk."""
    ends: list[np.ndarray] = []
    hits = np.zeros(0, np.int64)
    if len(data) >= WINDOW:
        starts = np.arange(len(data) - WINDOW + 1)
        rolled = texts.word_hashes(data, starts, starts + WINDOW, fold=False)
        hits = np.flatnonzero(rolled % np.uint64(MEAN_BYTES) == 0) + WINDOW
    for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        own, at = [], first
        # A window must lie within the text, else its neighbour in the batch would move the cut.
        lo, hi = np.searchsorted(hits, (first + WINDOW, last))
        for hit in hits[lo:hi].tolist():
            while hit - at > MOST_BYTES:
                at += MOST_BYTES
                own.append(at)
            if hit - at >= LEAST_BYTES:
                at = hit
                own.append(at)
        while last - at > MOST_BYTES:
            at += MOST_BYTES
            own.append(at)
        if last > at or not own:
            own.append(last)
        ends.append(np.array(own))
    return ends


def recipes(docs: DataFrame, key_bits: int = 64) -> DataFrame:
    """Per row: SHA-256 of the text, its length, and of its chunks in order key and digest.

    Keys of fewer bits collide more often; results stay the same.
    """
    most = (1 << key_bits) - 1

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for first, last, data, bounds in texts.text_chunks(batch.column(1)):
                whole, sizes, keys, digests, counts = [], [], [], [], [0]
                raw = data.tobytes()
                for i, ends in enumerate(cuts(data, bounds)):
                    at = int(bounds[i])
                    text = raw[at : int(bounds[i + 1])]
                    whole.append(hashlib.sha256(text).hexdigest())
                    sizes.append(len(text))
                    for end in ends.tolist():
                        chunk = raw[at:end]
                        keys.append(xxhash.xxh3_64_intdigest(chunk) & most)
                        digests.append(hashlib.sha256(chunk).digest())
                        at = end
                    counts.append(len(keys))
                chunk_type = pa.struct([("key", pa.int64()), ("digest", pa.binary())])
                chunk = pa.StructArray.from_arrays(
                    [pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(digests, pa.binary())],
                    fields=list(chunk_type),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, last - first),
                        pa.array(whole, pa.string()),
                        pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(counts, pa.int32()), chunk),
                    ],
                    ["doc_id", "text_sha256", "n_bytes", "chunks"],
                )

    schema = (
        "doc_id long, text_sha256 string, n_bytes long, "
        "chunks array<struct<key: long, digest: binary>>"
    )
    return docs.mapInArrow(lean(run), schema)


def doubtful_keys(rows: DataFrame) -> DataFrame:
    """Keys whose chunks do not all have one digest.

    Digests are compared as numbers: of each quarter of a digest the least and the greatest.
    """
    chunks = rows.select(F.explode("chunks").alias("c")).select("c.key", "c.digest")
    quarters = [
        F.conv(F.hex(F.substring("digest", 1 + 7 * i, 7)), 16, 10).cast("long") for i in range(4)
    ]
    extremes = [f(q).alias(f"{n}{i}") for i, q in enumerate(quarters) for n, f in (("lo", F.min), ("hi", F.max))]
    differ = F.lit(False)
    for i in range(4):
        differ = differ | (F.col(f"lo{i}") < F.col(f"hi{i}"))
    return chunks.groupBy("key").agg(*extremes).filter(differ).select("key")


def exact_duplicates(documents: DataFrame, key_bits: int = 64) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Null counts as an empty text. Of equal texts the largest doc_id stays; a null doc_id is an id
    below all others and comes back as null. Of rows with the same text and doc_id every one has
    ``kept`` true if that id stays, and each counts in ``group_size``. Other columns are ignored.
    """
    docs = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    rows = staged(recipes(docs, key_bits), "recipes")
    doubtful = doubtful_keys(rows)
    named = rows.withColumn("recipe", F.col("chunks.key"))
    # As a rule there are none. Their chunks get identifiers from the digest, in their documents only.
    if not doubtful.isEmpty():
        parts = rows.select("doc_id", "text_sha256", F.posexplode("chunks").alias("pos", "c"))
        exact = (
            parts.join(doubtful.withColumn("torn", F.lit(True)), parts["c.key"] == doubtful["key"], "left")
            .select(
                "doc_id", "text_sha256", "pos",
                F.when(F.col("torn"), F.xxhash64("c.digest", "c.key")).otherwise(F.col("c.key")).alias("part"),
            )
            .distinct()
            .groupBy("doc_id", "text_sha256")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "part"))), lambda x: x["part"]).alias("recipe"))
        )
        named = rows.join(exact, ["doc_id", "text_sha256"])
    # Only texts that occur more than once are looked up; one with very many copies stays spread.
    keys = ["n_bytes", "recipe"]
    groups = staged(
        named.groupBy(*keys).agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1"),
        "recipe-groups",
    )
    real = lambda name: F.when(F.col(name) != NULL_ID, F.col(name)).alias(name)
    found = lookup_join(named, groups, keys, "left", LOOKUP_BYTES).withColumns(
        {"keep_id": F.coalesce("keep_id", "doc_id"), "group_size": F.coalesce("group_size", F.lit(1).cast("long"))}
    )
    return found.select(
        real("doc_id"),
        real("keep_id"),
        "group_size",
        (F.col("doc_id") == F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
