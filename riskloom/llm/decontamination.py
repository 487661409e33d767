"""Benchmark decontamination by word windows.

The windows of the benchmark items, ``window`` words each, are hashed into sorted blocks of a fixed
greatest size. A block is broadcast, and every task looks up the hashes of all word windows of its
documents in it. A hit is verified word by word against the item. An item of fewer words is one
window of its own length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import texts
from riskloom.llm.folders import staged
from riskloom.llm.memory import lean

WINDOW = 10
#: Greatest size of a broadcast block of windows, in bytes of hashes and words.
BLOCK_BYTES = 32 << 20


def normalised_words(text: str | None) -> list[bytes]:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    bounds = np.array([0, len(raw)])
    starts, ends, _ = texts.word_bounds(raw, bounds, texts.ALPHANUMERIC)
    lowered = raw.tobytes().lower()
    return [lowered[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


def benchmark_windows(items: DataFrame, window: int) -> DataFrame:
    """(hash, length, words joined by a space, item_id): the distinct windows of every item."""

    def run(batches):
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = np.frombuffer((text or "").encode(), np.uint8)
                bounds = np.array([0, len(raw)])
                starts, ends, owner = texts.word_bounds(raw, bounds, texts.ALPHANUMERIC)
                if not len(starts):
                    continue
                words = normalised_words(text)
                length = min(window, len(words))
                at, hashes = texts.window_hashes(texts.word_hashes(raw, starts, ends), owner, length)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes.view(np.int64)),
                        pa.array([length] * len(at), pa.int32()),
                        pa.array([b" ".join(words[i : i + length]) for i in at.tolist()], pa.binary()),
                        pa.array([item] * len(at), pa.int64()),
                    ],
                    ["hash", "length", "words", "item_id"],
                )

    return items.mapInArrow(run, "hash long, length int, words binary, item_id long").distinct()


def _blocks(windows: DataFrame, block_bytes: int) -> list[DataFrame]:
    """The windows in blocks of about ``block_bytes``, by hash."""
    size = windows.agg(F.sum(F.octet_length("words") + 64)).first()[0] or 0
    n = max(1, -(-2 * size // block_bytes))
    if n == 1:
        return [windows]
    return [windows.filter(F.pmod("hash", F.lit(n)) == i) for i in range(n)]


def _scan(
    docs: DataFrame, block: DataFrame, every: bool, only: bool = False
) -> tuple[DataFrame, Broadcast]:
    """Per document: number of words and verified hits (start, length, item); the block's broadcast.

    ``every`` keeps documents without hits too. Where the block is the ``only`` one, hits are merged
    by the same task.
    """
    found: dict[tuple[int, int], dict[bytes, list[int]]] = {}
    for row in block.toLocalIterator():
        by_words = found.setdefault((row.length, row.hash), {})
        by_words.setdefault(bytes(row.words), []).append(-1 if row.item_id is None else row.item_id)
    lengths = sorted({length for length, _ in found})
    known = {n: np.sort(np.array([h for m, h in found if m == n], np.int64)) for n in lengths}
    shared = docs.sparkSession.sparkContext.broadcast((found, known))

    def run(batches):
        found, known = shared.value
        for batch in batches:
            for first, last, data, bounds in texts.text_chunks(batch.column(2)):
                starts, ends, owner = texts.word_bounds(data, bounds, texts.ALPHANUMERIC)
                words = texts.word_hashes(data, starts, ends)
                hits: list[list[dict]] = [[] for _ in range(last - first)]
                origin = np.searchsorted(owner, np.arange(last - first))
                for length, hashes in known.items():
                    at, seen = texts.window_hashes(words, owner, length)
                    seen = seen.view(np.int64)
                    place = np.minimum(np.searchsorted(hashes, seen), len(hashes) - 1)
                    for i in np.flatnonzero(hashes[place] == seen).tolist():
                        k = int(at[i])
                        span = zip(starts[k : k + length].tolist(), ends[k : k + length].tolist())
                        own = b" ".join(data[a:b].tobytes().lower() for a, b in span)
                        doc = int(owner[k])
                        for item in found[length, int(seen[i])].get(own, ()):
                            hits[doc].append(
                                {"start": k - int(origin[doc]), "length": length, "item_id": item}
                            )
                counts = np.bincount(owner, minlength=last - first)
                rows = pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        batch.column(1).slice(first, last - first),
                        pa.array(counts, pa.int64()),
                        pa.array(hits, _HITS),
                    ],
                    ["doc_id", "mark", "n_words", "hits"],
                )
                yield rows if every else rows.filter(pa.array([bool(h) for h in hits]))

    if only:
        rows = docs.mapInArrow(
            lean(lambda x: _merged(rows.select(["doc_id", "n_words", "hits"]) for rows in run(x))),
            _MERGED,
        )
    else:
        rows = docs.mapInArrow(
            lean(run),
            "doc_id long, mark long, n_words long, "
            "hits array<struct<start: long, length: int, item_id: long>>",
        )
    return rows, shared


def _scanned(docs: DataFrame, block: DataFrame, every: bool) -> DataFrame:
    """The rows of :func:`_scan` as a written table, so that the block can be given up at once."""
    rows, shared = _scan(docs, block, every)
    found = staged(rows if every else rows.distinct(), "benchmark-hits")
    shared.destroy()
    return found


_MERGED = "doc_id long, n_words long, n_hit long, items array<long>"
_HITS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int32()), ("item_id", pa.int64())]))


def _merged(batches):
    """Hit words and items of each document; overlapping windows count a word once."""
    for batch in batches:
        n_hit, items = [], []
        for hits in batch.column(2).to_pylist():
            end = total = 0
            for start, length in sorted({(h["start"], h["length"]) for h in hits or ()}):
                total += max(0, start + length - max(start, end))
                end = max(end, start + length)
            n_hit.append(total)
            items.append(sorted({h["item_id"] for h in hits or ()}))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.int64()))],
            ["doc_id", "n_words", "n_hit", "items"],
        )


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): ``n_words``, ``n_hit``, ``items`` (ids, ascending).

    ``benchmark`` has item_id and text. Words are runs of letters and digits after lower-casing
    A-Z. Null texts and items have no words; an item without words has no window. A null item_id is
    reported as -1, a null doc_id stays null. Repeated rows are treated one by one. Other columns
    are ignored. An empty benchmark gives no hits.
    """
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("mark"),
        F.col("text").cast("string").alias("text"),
    )
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    windows = staged(benchmark_windows(items, window), "benchmark-windows")
    blocks = _blocks(windows, block_bytes)
    if len(blocks) == 1:
        return _scan(docs, blocks[0], every=True, only=True)[0]
    # One block is in memory at a time; a document that several hit is put together again.
    rows = _scanned(docs, blocks[0], every=True)
    later = _scanned(docs, blocks[1], every=False)
    for block in blocks[2:]:
        later = later.unionByName(_scanned(docs, block, every=False))
    more = (
        later.withColumn("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))))
        .groupBy("doc_id", "mark", "n_words")
        .agg(F.flatten(F.collect_list("hits")).alias("more"))
    )
    rows = (
        rows.withColumn("id", F.coalesce("doc_id", F.lit(-(1 << 63))))
        .join(more.withColumnRenamed("doc_id", "id"), ["id", "mark", "n_words"], "left")
        .withColumn("hits", F.concat("hits", F.coalesce("more", F.array().cast("array<struct<start: long, length: int, item_id: long>>"))))
    )
    return rows.select("doc_id", "n_words", "hits").mapInArrow(
        lean(_merged), _MERGED
    )
