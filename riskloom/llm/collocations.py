"""Phrases whose words belong together, found by best-first branch and bound.

Words are grown to pairs and pairs to triples. The score of a phrase that starts with the pair xy is
at most f(xy)/f(x), and that of the pair at least as little, so the pairs in the order of this bound
are the frontier. Every round lowers a language's threshold, counts in one scan of the corpus the
triples that grow from the pairs that it reaches (and those that can swallow a pair that reaches it),
and scores them exactly. A language is settled once its 2000th surviving score is not below its
threshold: what was not grown cannot reach it.

A word is a 64-bit hash of itself and its language. Tasks count n-grams exactly within a run of words,
by numbers they give to its words; Spark adds up. What a scan has to count is told by bitmaps of fixed
size; whatever they let through by chance falls out of an exact join afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import texts
from riskloom.llm.folders import staged
from riskloom.llm.memory import lean
from riskloom.operators.joins import lookup_join

LEAST_COUNT = 10
TOP = 2000
SCALE = 1_000_000
#: Bits of a bitmap and n-grams that are counted at once by a task.
FILTER_BITS = 26
RUN_WORDS = 1 << 20
CHUNK_BYTES = 4 << 20
#: Counts that are broadcast to be looked up; larger ones are joined by a shuffle.
LOOKUP_BYTES = 16 << 20
#: Reached by the first threshold: so many times TOP pairs of a language.
FIRST_REACH = 2
NO_LANGUAGE = "und"

#: Bytes of words: not blank, tab or a break; breaks are [.,;:!?\x0A-\x0D].
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(10, 14)]] = True
_WORD = ~_BREAK
_WORD[[9, 32]] = False

PAIR, TRIPLE = ["x", "y"], ["x", "y", "z"]


# --- in the tasks -------------------------------------------------------------------------------


def pair_key(x, y):
    """One number of two words' numbers, the same in numpy and, by :func:`_sql_key`, in Spark."""
    return x ^ ((y << np.uint64(1)) | (y >> np.uint64(63)))


def _sql_key(x: str, y: str) -> Column:
    y = F.col(y)
    return F.col(x).bitwiseXOR(F.shiftleft(y, 1).bitwiseOR(F.shiftrightunsigned(y, 63)))


def _has(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & np.uint64((1 << FILTER_BITS) - 1)
    return (bitmap[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Runs of texts of one language: the language, words' hashes, pieces, and bytes with bounds."""
    for batch in batches:
        column = batch.column(0).dictionary_encode()
        for number, language in enumerate(column.dictionary.to_pylist()):
            own = pa.compute.equal(column.indices, number)
            salt = np.uint64(xxhash.xxh3_64_intdigest(language.encode()))
            for _, _, data, bounds in texts.text_chunks(batch.column(1).filter(own), CHUNK_BYTES):
                starts, ends, _ = texts.word_bounds(data, bounds, _WORD)
                if not len(starts):
                    continue
                words = texts.mix(texts.word_hashes(data, starts, ends) ^ salt)
                cuts = np.union1d(np.flatnonzero(_BREAK[data]), bounds[1:-1])
                pieces = np.searchsorted(cuts, starts, "right")
                yield language, words, pieces, data, starts, ends


def _table(columns: dict[str, np.ndarray], language: str | None = None) -> pa.RecordBatch:
    arrays = {k: pa.array(v.view(np.int64) if v.dtype == np.uint64 else v) for k, v in columns.items()}
    if language is not None:
        n = len(next(iter(columns.values())))
        arrays = {"lang": pa.repeat(pa.scalar(language), n)} | arrays
    return pa.RecordBatch.from_arrays(list(arrays.values()), list(arrays))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for language, words, _, data, starts, ends in _words(batches):
        known, first, counts = np.unique(words, return_index=True, return_counts=True)
        raw = data.tobytes().lower()
        spelled = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        table = _table({"x": known, "a": counts.astype(np.int64)}, language)
        yield table.append_column("word", pa.array(spelled, pa.binary()).cast(pa.string()))


def _grams(words: np.ndarray, pieces: np.ndarray, length: int, wanted: np.ndarray) -> list[np.ndarray]:
    """Distinct n-grams at the places ``wanted``, word by word, and how often each stands there.

    The words of a run are numbered, so an n-gram is one number exactly.
    """
    known, numbers = np.unique(words, return_inverse=True)
    # At most RUN_WORDS + 2 words: the number of a triple stays below 2**63.
    code = np.zeros(len(wanted), np.int64)
    for j in range(length):
        code = code * len(known) + numbers[wanted + j]
    _, first, counts = np.unique(code, return_index=True, return_counts=True)
    at = wanted[first]
    return [*(words[at + j] for j in range(length)), counts.astype(np.int64)]


def _count(length: int, bitmaps, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of frequent words; or triples that grow from a wanted pair or end with one."""
    maps = [np.frombuffer(b, np.uint64) for b in bitmaps.value]
    names = [*TRIPLE[:length], "a"]
    for _, words, pieces, *_ in _words(batches):
        for first in range(0, len(words) - length + 1, RUN_WORDS):
            run = words[first : first + RUN_WORDS + length - 1]
            piece = pieces[first : first + RUN_WORDS + length - 1]
            n = len(run) - length + 1
            good = piece[:n] == piece[length - 1 :]
            if length == 2:
                frequent = _has(maps[0], run)
                good &= frequent[:-1] & frequent[1:]
            else:
                keys = pair_key(run[:-1], run[1:])
                frequent = _has(maps[0], keys)
                good &= frequent[:-1] & frequent[1:]
                good &= _has(maps[1], keys)[:-1] | _has(maps[2], keys)[1:]
            wanted = np.flatnonzero(good)
            if len(wanted):
                yield _table(dict(zip(names, _grams(run, piece, length, wanted))))


# --- in Spark -----------------------------------------------------------------------------------


def _bitmap(keys: DataFrame) -> bytes:
    """Bitmap of the column ``key``: at most 2**FILTER_BITS bits reach the driver, whatever their number."""
    slot = F.col("key").bitwiseAND((1 << FILTER_BITS) - 1)
    bits = (
        keys.select(F.shiftright(slot, 6).alias("slot"), slot.bitwiseAND(63).cast("int").alias("bit"))
        .select("slot", F.expr("shiftleft(1L, bit)").alias("bits"))
        .groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    )
    found = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    found[bits.column("slot").to_numpy()] = bits.column("bits").to_numpy()
    return found.tobytes()


def _counted(docs: DataFrame, length: int, keys: list[DataFrame]) -> DataFrame:
    """n-grams of ``length`` words with at least LEAST_COUNT occurrences, from one scan of the corpus."""
    bitmaps = docs.sparkSession.sparkContext.broadcast([_bitmap(k) for k in keys])
    names = TRIPLE[:length]
    rows = docs.mapInArrow(
        lean(lambda batches: _count(length, bitmaps, batches)), ", ".join(f"{c} long" for c in [*names, "a"])
    )
    found = staged(
        rows.groupBy(*names).agg(F.sum("a").alias("a")).filter(F.col("a") >= LEAST_COUNT), f"phrases-{length}"
    )
    bitmaps.destroy()
    return found


def _score(a: str, left: str, right: str) -> Column:
    """floor(SCALE * a * a / (left * right)) in decimal numbers, exact for counts up to 10**15."""
    wide = {c: F.col(c).cast("decimal(16,0)") for c in (a, left, right)}
    top = F.lit(SCALE).cast("decimal(7,0)") * wide[a] * wide[a]
    return F.call_function("div", top, wide[left] * wide[right])


def _looked_up(rows: DataFrame, found: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    return lookup_join(rows, found, on, how, LOOKUP_BYTES)


def _named(counts: DataFrame, on: dict[str, str], **values: str) -> DataFrame:
    """Columns of ``counts`` under other names, to be looked up."""
    return counts.select(*[F.col(k).alias(v) for k, v in on.items()], *[F.col(k).alias(v) for k, v in values.items()])


def _thresholds(pairs: DataFrame, settled: DataFrame | None, reach: int) -> DataFrame:
    """Per language the score of its ``reach``-th pair, 0 if it has fewer."""
    per_score = pairs.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("n"))
    # A language has at most SCALE + 1 scores.
    down = Window.partitionBy("lang").orderBy(F.desc("score"))
    reached = F.coalesce(F.max(F.when(F.col("upto") >= reach, F.col("score"))), F.lit(0))
    rows = per_score.withColumn("upto", F.sum("n").over(down)).groupBy("lang").agg(reached.alias("threshold"))
    return rows if settled is None else rows.join(settled, "lang", "left_anti")


def collocations(
    documents: DataFrame, least: int = LEAST_COUNT, top: int = TOP, swallowed: int = 50
) -> DataFrame:
    """The first ``top`` phrases of two or three words of each language, with lang, rank, phrase, a, l,
    r, n and score.

    Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends, and those into words
    at blanks and tabs. ``a`` is the number of times the phrase stands within pieces, at least
    ``least``. The cut after k words with the lowest score floor(1000000 a a / (l r)) counts, the
    smallest k among equal ones. A phrase is dropped if it lies in a longer one, dropped or not, that
    stands at least ``least`` times and at least ``swallowed`` per cent as often. The order is by
    score, a, and the phrase's bytes.

    A null text is empty, a null lang is "und". Repeated rows count each. Other columns are ignored.
    Words are told apart by 64 bits.
    """
    if least < LEAST_COUNT:
        raise ValueError(f"phrases are counted from {LEAST_COUNT} occurrences")
    docs = documents.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    spelled = staged(docs.mapInArrow(lean(_count_words), "lang string, x long, a long, word string"), "phrases-words")
    words = staged(spelled.groupBy("lang", "x").agg(F.sum("a").alias("a")), "phrases-1")
    sizes = words.groupBy("lang").agg(F.sum("a").alias("n"))
    words = words.filter(F.col("a") >= least)
    pairs = _counted(docs, 2, [words.select(F.col("x").alias("key"))]).filter(F.col("a") >= least)
    pairs = _looked_up(pairs, _named(words, {"x": "x"}, lang="lang", a="l"), ["x"], "inner")
    pairs = _looked_up(pairs, _named(words, {"x": "y"}, a="r"), ["y"], "inner")
    pairs = staged(
        pairs.withColumn("score", _score("a", "l", "r"))
        .withColumn("bound", F.call_function("div", F.lit(SCALE) * F.col("a"), F.col("l"))),
        "phrases-pairs",
    )
    frequent = _sql_key("x", "y").alias("key")
    triples, done, settled, reach = [], None, None, FIRST_REACH * top
    survivors: list[DataFrame] = []
    while True:
        levels = staged(_thresholds(pairs, settled, reach), "phrases-thresholds")
        if levels.isEmpty():
            break
        open_pairs = _looked_up(pairs, levels, ["lang"], "inner")
        grown = open_pairs.filter("bound >= threshold").select(*PAIR)
        reaching = open_pairs.filter("score >= threshold")
        if done is not None:
            # Those that grew in an earlier round have been counted.
            earlier = _looked_up(pairs, done, ["lang"], "inner").filter("bound >= threshold").select(*PAIR)
            grown = grown.join(earlier, PAIR, "left_anti")
        counted = _counted(
            docs, 3,
            [pairs.select(frequent), grown.select(frequent), reaching.select(frequent)],
        ).filter(F.col("a") >= least)
        triples.append(counted)
        known = triples[0]
        for more in triples[1:]:
            known = known.unionByName(more)
        known = staged(_scored_triples(known.distinct() if len(triples) > 1 else known, pairs, words), "phrases-triples")
        triples = [known.select(*TRIPLE, "a")]
        kept = staged(_survivors(open_pairs, _looked_up(known, levels, ["lang"], "inner"), swallowed), "phrases-kept")
        enough = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_kept"))
        over = staged(
            levels.join(enough, "lang", "left").filter((F.col("threshold") == 0) | (F.col("n_kept") >= top)).select("lang"),
            "phrases-settled",
        )
        survivors.append(_looked_up(kept, over, ["lang"], "left_semi"))
        settled = over if settled is None else settled.unionByName(over)
        done = levels
        reach *= 4
    if not survivors:
        return docs.sparkSession.createDataFrame(
            [], "lang string, rank long, phrase string, a long, l long, r long, n long, score long"
        )
    found = survivors[0]
    for more in survivors[1:]:
        found = found.unionByName(more)
    return _spelled(found, spelled, sizes, top)


def _scored_triples(triples: DataFrame, pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Triples with their language and the l, r and score of the cut that counts."""
    rows = _looked_up(triples, _named(words, {"x": "x"}, lang="lang", a="f_x"), ["x"], "inner")
    rows = _looked_up(rows, _named(words, {"x": "z"}, a="f_z"), ["z"], "inner")
    rows = _looked_up(rows, _named(pairs, {"x": "x", "y": "y"}, a="f_xy"), PAIR, "inner")
    rows = _looked_up(rows, _named(pairs, {"x": "y", "y": "z"}, a="f_yz"), ["y", "z"], "inner")
    rows = rows.withColumn("first", _score("a", "f_x", "f_yz")).withColumn("second", _score("a", "f_xy", "f_z"))
    one = F.col("first") <= F.col("second")
    return rows.select(
        *TRIPLE, "lang", "a",
        F.when(one, F.col("f_x")).otherwise(F.col("f_xy")).alias("l"),
        F.when(one, F.col("f_yz")).otherwise(F.col("f_z")).alias("r"),
        F.least("first", "second").alias("score"),
    )


def _survivors(pairs: DataFrame, triples: DataFrame, swallowed: int) -> DataFrame:
    """What reaches the threshold and is not swallowed by a triple; all such triples are known."""
    holders = triples.select("x", "y", F.col("a").alias("longest")).unionByName(
        triples.select(F.col("y").alias("x"), F.col("z").alias("y"), F.col("a").alias("longest"))
    ).groupBy(*PAIR).agg(F.max("longest").alias("longest"))
    alone = _looked_up(pairs.filter("score >= threshold"), holders, PAIR).filter(
        F.col("longest").isNull() | (100 * F.col("longest") < swallowed * F.col("a"))
    )
    columns = [*TRIPLE, "lang", "a", "l", "r", "score"]
    return alone.withColumn("z", F.lit(None).cast("long")).select(*columns).unionByName(
        triples.filter("score >= threshold").select(*columns)
    )


def _spelled(found: DataFrame, spelled: DataFrame, sizes: DataFrame, top: int) -> DataFrame:
    """The first phrases of each language by score, count and the phrase itself."""
    close = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    # Ties at the end are settled by the phrases, so all of them are spelled.
    best = staged(found.withColumn("at", F.rank().over(close)).filter(F.col("at") <= top).drop("at"), "phrases-best")
    needed = best.select(F.explode(F.array("x", "y", "z")).alias("x")).dropna().distinct()
    names = staged(
        _looked_up(spelled.select("x", "word"), needed, ["x"], "left_semi").groupBy("x").agg(F.min("word").alias("word")),
        "phrases-names",
    )
    rows = best
    for place in TRIPLE:
        rows = _looked_up(rows, _named(names, {"x": place}, word=f"{place}_word"), [place])
    last = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        rows.withColumn("phrase", F.concat_ws(" ", *[f"{place}_word" for place in TRIPLE]))
        .withColumn("rank", F.row_number().over(last).cast("long"))
        .filter(F.col("rank") <= top)
        .join(sizes, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
    )
