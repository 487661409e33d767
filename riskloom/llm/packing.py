"""Harmonic packing of token sequences.

A length l belongs to class j = capacity // l: j pieces of the class fit in one sequence, whatever
their lengths, so every sequence of a class takes j pieces and no worker needs to know the others'.
Each task numbers its pieces within their classes; from the counts per task and class follows every
piece's number in its class, and its sequence by division. A document is cut into whole sequences;
a rest that would leave much of its share empty is cut once more at the next smaller share.

Only the last, unfilled sequence of each class remains. Those fewer than ``capacity`` sequences,
whatever the size of the corpus, are packed best-fit decreasing.
"""

from __future__ import annotations

import bisect
import itertools
import os
import string
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.folders import staged
from riskloom.llm.memory import lean
from riskloom.llm.texts import text_chunks
from riskloom.operators.joins import lookup_join

CAPACITY = 4096
END_ID = 2
#: A rest is cut again if it would leave more than this part of itself empty.
SLACK = 0.03
MOST_CUTS = 3
CHUNK_BYTES = 1 << 20
#: Most pieces of words that a worker keeps before it starts anew.
CACHE_PIECES = 600_000

_TAIL = "".join(sorted(set(string.punctuation) - set("'")))
#: Letters that composing leaves alone and whose lower case is one letter.
_LETTERS = string.ascii_letters + "".join(c for c in map(chr, range(0xC0, 0x100)) if c not in "×÷")
_LATIN = rf"\A[{_LETTERS}]+\z"
_tokenizers: dict[str, WordTokenizer] = {}


class WordTokenizer:
    """A tokenizer whose words are independent of each other, with a bounded cache of their pieces.

    Words are what blanks and line ends part. A word of Latin letters, with punctuation after them or
    not, is two pieces, a stem and a tail; any other word is one piece. Arrow numbers the distinct words
    of a run of texts, so that only those are looked up. Stems are tokenised many at a time and parted
    at the tokens that end a word; where the count of those does not fit, and for all other pieces, each
    is tokenised alone.
    """

    def __init__(self, path: str):
        # Spark runs a task on each core; threads of the tokenizer would each hold memory of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # For stems, which normalising leaves as they are and which are one part: the same model, held
        # once, behind a plain split at blanks.
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        #: Place of each piece in ``sizes`` and ``firsts``, which tell its ids in ``flat``.
        self.pieces: dict[str, int] = {"": 0}
        self.sizes = np.zeros(1 << 16, np.int32)
        self.firsts = np.zeros(1 << 16, np.int64)
        self.flat = np.zeros(1 << 18, np.uint32)
        self.used = 0

    def _encode(self, rows: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows in one array, and the number of each row's."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(rows, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int32, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def _store(self, names: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
        count, used = len(self.pieces), self.used + len(flat)
        self.sizes = _room(self.sizes, count + len(names))
        self.firsts = _room(self.firsts, count + len(names))
        self.flat = _room(self.flat, used)
        self.sizes[count : count + len(names)] = sizes
        self.firsts[count : count + len(names)] = self.used + np.cumsum(sizes) - sizes
        self.flat[self.used : used] = flat
        self.used = used
        self.pieces.update(zip(names, range(count, count + len(names))))

    def _learn_stems(self, stems: list[str]) -> None:
        """Lower-case Latin words, many in one call."""
        groups = [stems[i : i + 500] for i in range(0, len(stems), 500)]
        encoded = self.plain.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
        for group, own in zip(groups, encoded):
            flat = np.array(own.ids, np.uint32)
            cuts = np.flatnonzero(self.ends[flat]) + 1
            if len(cuts) == len(group):
                self._store(group, flat[: cuts[-1]], np.diff(cuts, prepend=0))
            else:
                self._store(group, *self._encode(group))

    def _learn(self, pieces: list[str]) -> None:
        latin = pc.match_substring_regex(pa.array(pieces, pa.string()), pattern=_LATIN).to_pylist()
        self._learn_stems(list(itertools.compress(pieces, latin)))
        singles = [piece for piece, stem in zip(pieces, latin) if not stem]
        self._store(singles, *self._encode(singles))

    def _places(self, pieces: pa.DictionaryArray) -> np.ndarray:
        """The place of each of the pieces, new ones are learned."""
        names = pieces.dictionary.to_numpy(zero_copy_only=False)
        place = np.fromiter(map(self.pieces.get, names, itertools.repeat(-1)), np.int64, len(names))
        unknown = np.flatnonzero(place < 0)
        if len(unknown):
            new = names[unknown].tolist()
            self._learn(new)
            place[unknown] = np.fromiter(map(self.pieces.__getitem__, new), np.int64, len(new))
        return place[pieces.indices.to_numpy()]

    def ids(self, texts: pa.StringArray) -> list[np.ndarray]:
        """The token ids of each text; none is null."""
        if len(self.pieces) > CACHE_PIECES:
            self.clear()
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        counts = pc.list_value_length(split).to_numpy()
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary
        stem = pc.ascii_rtrim(distinct, characters=_TAIL)
        latin = pc.match_substring_regex(stem, pattern=_LATIN)
        stem = pc.if_else(latin, pc.utf8_lower(stem), distinct)
        tail = pc.if_else(latin, pc.utf8_ltrim(distinct, characters=_LETTERS), "")
        parts = [self._places(part.dictionary_encode()) for part in (stem, tail)]
        pieces = np.stack(parts, axis=1).ravel()
        flat, ends = _runs(self.flat, self.firsts[pieces], self.sizes[pieces])
        ends = ends[1::2]
        sizes = np.diff(ends, prepend=0)
        place = words.indices.to_numpy()
        flat, ends = _runs(flat, (ends - sizes)[place], sizes[place])
        cuts = np.concatenate([[0], ends])[np.cumsum(counts)]
        return np.split(flat, cuts[:-1]) if len(texts) else []


def _runs(values: np.ndarray, firsts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``values`` one after another, and where each ends there."""
    ends = np.cumsum(sizes, dtype=np.int64)
    at = np.repeat(firsts - (ends - sizes), sizes)
    at += np.arange(len(at))
    return values[at], ends


def _room(array: np.ndarray, count: int) -> np.ndarray:
    """``array`` with space for ``count`` values at least."""
    while count > len(array):
        array = np.concatenate([array, np.zeros_like(array)])
    return array


def tokenizer_at(path: str) -> WordTokenizer:
    """One tokenizer for each Python worker."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def cuts(total: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document."""
    pieces = [capacity] * (total // capacity)
    rest = total % capacity
    while rest and len(pieces) < total // capacity + MOST_CUTS:
        share = capacity // rest
        if capacity // share - rest <= SLACK * rest or capacity // (share + 1) < 1:
            break
        pieces.append(capacity // (share + 1))
        rest -= pieces[-1]
    return pieces + [rest] if rest else pieces


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int) -> DataFrame:
    """Pieces of all documents, numbered by task within their class."""

    def run(batches):
        words = tokenizer_at(tokenizer)
        task = TaskContext.get().partitionId()
        counts = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for first, last, _, _ in text_chunks(batch.column(1), CHUNK_BYTES):
                out = []
                ids, rows = (c.slice(first, last - first) for c in batch.columns[:2])
                for doc_id, own in zip(ids.to_pylist(), words.ids(rows.cast(pa.string()))):
                    own = np.append(own, np.uint32(END_ID)).astype("<u4")
                    start = 0
                    for length in cuts(len(own), capacity):
                        share = capacity // length
                        crc = zlib.crc32(own[start : start + length].tobytes())
                        out.append((doc_id, start, length, crc, len(own), task, share, int(counts[share])))
                        counts[share] += 1
                        start += length
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in zip(*out)],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "share", "number"],
                )
        # The worker lives on for other tasks, which need the memory.
        words.clear()

    return docs.mapInArrow(
        lean(run),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
        "task long, share long, number long",
    )


def _best_fit(batches, capacity: int):
    """Pack the pieces of unfilled sequences, longest first; at most one row per class and share."""
    import pandas as pd

    frame = pd.concat(list(batches), ignore_index=True)
    if frame.empty:
        return
    frame = frame.sort_values(
        ["length", "doc_id", "start", "task", "share", "number"], ascending=[False] + [True] * 5,
        kind="stable",
    )
    room: list[tuple[int, int]] = []
    n, sequences, offsets = 0, [], []
    for length in frame["length"].tolist():
        at = bisect.bisect_left(room, (length, -1))
        if at < len(room):
            left, sequence = room.pop(at)
        else:
            left, sequence, n = capacity, n, n + 1
        sequences.append(sequence)
        offsets.append(capacity - left)
        if left > length:
            bisect.insort(room, (left - length, sequence))
    yield frame.assign(sequence_id=sequences, offset=offsets)


def harmonic_packing(
    documents: DataFrame, tokenizer: str, capacity: int = CAPACITY
) -> DataFrame:
    """The pieces of ``documents`` (doc_id, text) with their sequence and their place in it.

    A document is the ids of its text and a closing id; a null text is empty, so it has the closing
    id only. ``length`` ids from ``start`` on stand at ``offset`` of sequence ``sequence_id``. No
    sequence is longer than ``capacity``; what is missing is padding after the last piece.
    ``ids_crc32`` is the checksum of the piece's ids as little-endian 32-bit numbers. A null doc_id
    stays null, rows that repeat an id are packed one by one, other columns are ignored.
    """
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    pieces = staged(pieces_of(docs, tokenizer, capacity), "packing-pieces")
    counts = pieces.groupBy("share", "task").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("share").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    # One row per class, fewer than ``capacity``.
    full = counts.groupBy("share").agg(F.floor(F.sum("n") / F.col("share")).alias("full"))
    lower = Window.orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    classes = full.withColumn("base", F.coalesce(F.sum("full").over(lower), F.lit(0)))
    n_full = classes.agg(F.coalesce(F.sum("full"), F.lit(0))).first()[0]

    places = staged(
        before.join(F.broadcast(classes), "share").select("share", "task", "before", "full", "base"),
        "packing-classes",
    )
    numbered = (
        lookup_join(pieces, places, ["share", "task"], "inner")
        .withColumn("rank", F.col("before") + F.col("number"))
        .withColumn("bin", F.floor(F.col("rank") / F.col("share")))
    )
    within = Window.partitionBy("sequence_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    done = (
        numbered.filter("bin < full")
        .withColumn("sequence_id", F.col("base") + F.col("bin"))
        .withColumn("offset", F.sum("length").over(within) - F.col("length"))
        .select(columns)
    )
    schema = (
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task long, "
        "share long, number long, sequence_id long, offset long"
    )
    rest = (
        numbered.filter("bin >= full")
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "share", "number")
        .repartition(1)
        .mapInPandas(lambda x: _best_fit(x, capacity), schema)
        .withColumn("sequence_id", F.col("sequence_id") + F.lit(n_full))
        .select(columns)
    )
    return done.unionByName(rest)
