"""Exact n-gram Jaccard join by universe partition and the pigeonhole principle.

Two sets of a and b shingles with a Jaccard similarity of at least ``percent`` differ in at most
H shingles. The universe of shingles is cut by hash into segments; whoever differs in at most H
shingles agrees wholly on at least one of any H + 1 segments. So documents that may be linked meet
in a segment signature.

*Size bands.* A pair belongs to the band of its smaller set. A document signs for its own band and
for the one below it, if a partner may lie there.

*Allocation.* Each segment of a document gets a budget of differences: -1 (no signature) if it is
empty or its subset is frequent in the corpus, 0 (signature of the subset) for the first H + 1
others. The number of segments of a band is the one whose expected number of signatures is
smallest. A document without H + 1 rare segments gets a budget of +1 (signatures of the one-deletion
neighbours too) where none of the neighbours is frequent. Only those that still fall short, as a
rule members of large groups of near copies, sign for frequent subsets as well, and those with too
few filled segments for all neighbours and empty segments. Both partners of a pair that needs such
signatures write them, so no link is lost.

*Verification.* Of the documents that meet in a signature, each is first compared with the one it
meets most often. Then the strays of a large component (documents that meet it in signatures, but
lie outside) are compared with a few of its members. At last all members of a signature that still
lie in different components are compared, those of large components in blocks.
A histogram of the hashes bounds the difference from below and refutes most chance meetings;
what remains is compared shingle by shingle (as 64-bit hashes).

Frequent subsets are found on a fixed share of the documents. They only steer which signatures are
written; the result does not depend on them.

Method: Deng, Li, Wen, Feng, "An efficient partition based method for exact set similarity joins"
(PVLDB 2015).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import texts
from riskloom.llm.folders import staged
from riskloom.llm.memory import lean
from riskloom.operators.components import star_labels
from riskloom.operators.joins import lookup_join

SHINGLE_WORDS = 5
PERCENT = 80
BAND_RATIO = 1.5
#: One document of so many is looked at to find frequent subsets; so many meetings make one.
SAMPLE_SHARE = 32
FREQUENT = 3
MOST_FREQUENT = 1 << 20
#: Signatures that only documents without enough rare segments write are dealt to so many groups.
SALTS = 64
BUCKETS = 64
#: Strays that would be listed with so many members of a component's signatures are compared with a
#: few members first (so many in each of at most so many rounds), and then in blocks of so many
#: bytes of shingles.
FAMILY = 2048
PIVOTS = 6
ROUNDS = 2
BLOCK_BYTES = 1 << 18
#: Bytes of torn signatures that are broadcast; more are joined by a shuffle.
LOOKUP_BYTES = 64 << 20
NULL_ID = -(1 << 63)

_SEGMENT = np.uint64(0x8CB92BA72F3D8DD7)
_BAND = np.uint64(0xC2B2AE3D27D4EB4F)
_KINDS = np.array([0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


class Bands:
    """Size bands with their numbers of segments."""

    def __init__(self, percent: int, largest: int = 1 << 27):
        self.percent = percent
        lows = [1]
        while lows[-1] <= largest:
            lows.append(max(lows[-1] + 1, int(np.ceil(lows[-1] * max(BAND_RATIO, 100 / percent)))))
        self.lows = np.array(lows, np.int64)
        tops = self.lows[1:] - 1
        needed = self.difference(tops, tops * 100 // percent) + 1
        self.segments = np.array(
            [cheapest_segments(int(k), (lo + hi) / 2) for k, lo, hi in zip(needed, lows, tops)],
            np.uint64,
        )

    def difference(self, a, b):
        """Most shingles in which linked sets of sizes a and b can differ."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.lows, sizes, "right") - 1

    def roles(self, sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Band (or -1) and number of segments that must agree: in the own and in the lower band."""
        own = self.of(sizes)
        smallest = -(-sizes * self.percent // 100)
        lower = self.of(smallest)
        top = self.lows[own] - 1
        largest = sizes * 100 // self.percent
        return [
            (own, self.difference(sizes, largest) + 1),
            (np.where(lower < own, lower, -1), self.difference(top, sizes) + 1),
        ]


def cheapest_segments(needed: int, size: float) -> int:
    """The number of segments with the fewest expected signatures.

    Missing segments are paid with the one-deletion neighbours of a filled one; segments of a
    single shingle meet too many documents, so they are charged as if they were two signatures.
    """
    def cost(m: int) -> float:
        mean = size / m
        empty = np.exp(-mean)
        filled, spread = m * (1 - empty), np.sqrt(m * empty) + 1e-9
        short = (needed - filled) / spread
        tail = np.exp(-short * short / 2) / 2.507
        missing = spread * (tail + short * 0.5 * (1 + np.tanh(short * 0.8)))
        return needed * (1 + mean * empty) + max(missing, 0) * (mean + 1)

    tried = {max(needed, int(needed * k / 100)) for k in range(100, 171, 5)}
    return min(sorted(tried), key=cost)


def _id(name: str = "doc_id"):
    return F.coalesce(F.col(name).cast("long"), F.lit(NULL_ID))


def _sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of documents: ids, shingle hashes, the documents' numbers."""
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    for first, last, data, bounds in texts.text_chunks(batch.column(1)):
        hashes, owner = texts.shingle_sets(data, bounds, texts.NOT_SPACE, words)
        yield ids[first:last], hashes, owner


def sketches(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """Per document: set size, two sums that tell equal sets, histogram of the hashes."""

    def run(batches):
        for batch in batches:
            for ids, hashes, owner in _sets(batch, words):
                n = len(ids)
                sums = []
                for salt in (1, 2):
                    total = np.zeros(n, np.uint64)
                    np.add.at(total, owner, texts.mix(hashes + np.uint64(salt)))
                    sums.append(total.view(np.int64))
                cells = owner * BUCKETS + (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)
                # Cutting counts off keeps their differences a lower bound.
                counts = np.minimum(np.bincount(cells, minlength=n * BUCKETS), 65535)
                blob = counts.astype("<u2").tobytes()
                width = 2 * BUCKETS
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(np.bincount(owner, minlength=n), pa.int64()),
                        pa.array(sums[0]),
                        pa.array(sums[1]),
                        pa.array([blob[i * width : (i + 1) * width] for i in range(n)], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "sum_a", "sum_b", "histogram"],
                )

    schema = "doc_id long, n_shingles long, sum_a long, sum_b long, histogram binary"
    return docs.mapInArrow(lean(run), schema)


def sign(
    hashes: np.ndarray,
    owner: np.ndarray,
    n_docs: int,
    bands: Bands,
    frequent: np.ndarray,
    everything: bool = False,
) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Signatures of documents, the documents' numbers, and whether only some documents write them.

    ``everything`` signs for all filled segments and their one-deletion neighbours, to count them.
    """
    sizes = np.bincount(owner, minlength=n_docs)
    starts_of = np.cumsum(sizes) - sizes
    values = texts.mix(hashes)
    for band, needed in bands.roles(np.maximum(sizes, 1)):
        here = (band >= 0) & (sizes > 0)
        if not here.any():
            continue
        taken = here[owner]
        u, d, v = hashes[taken], owner[taken], values[taken]
        segments = bands.segments[band]
        segment = (u >> np.uint64(32)) * segments[d] >> np.uint64(32)
        new = np.ones(len(u), bool)
        new[1:] = (d[1:] != d[:-1]) | (segment[1:] != segment[:-1])
        at = np.flatnonzero(new)
        total = np.add.reduceat(v, at)
        doc, part = d[at], segment[at]
        base = texts.mix(band[doc].astype(np.uint64) * _BAND + part * _SEGMENT)
        plain = texts.mix(total + base)
        group = np.cumsum(new) - 1
        several = np.diff(np.append(at, len(u))) > 1

        def neighbours(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Signatures of the segments without one shingle, and the segments' numbers."""
            g = group[chosen]
            return texts.mix(total[g] - v[chosen] + base[g]), g

        if everything:
            yield plain, doc, 0
            fewer, g = neighbours(several[group])
            yield fewer, doc[g], 0
            continue
        rare = ~_among(frequent, plain)
        first = np.searchsorted(doc, np.arange(n_docs))
        n_filled = np.bincount(doc, minlength=n_docs)

        def rank(chosen: np.ndarray) -> np.ndarray:
            running = np.cumsum(chosen)
            return running - np.concatenate([[0], running])[first][doc]

        n_rare = np.bincount(doc, rare, n_docs)
        chosen = rare & (rank(rare) <= needed[doc])
        yield plain[chosen], doc[chosen], 0

        lacking = here & (n_rare < needed)
        if not lacking.any():
            continue
        fewer, g = neighbours(lacking[d] & several[group])
        known = _among(frequent, fewer)
        safe = rare & several & (np.bincount(g, known, len(at)) == 0)
        covered = lacking & (n_rare + np.bincount(doc, safe, n_docs) >= needed)
        chosen = rare & lacking[doc]
        yield texts.mix(plain[chosen] + _KINDS[0]), doc[chosen], 0
        yield texts.mix(fewer[~known] + _KINDS[0]), doc[g[~known]], 0

        lacking &= ~covered
        chosen = lacking[doc] & (rank(np.ones(len(doc), bool)) <= needed[doc])
        yield texts.mix(plain[chosen] + _KINDS[1]), doc[chosen], 1

        sparse = lacking & (n_filled < needed)
        if not sparse.any():
            continue
        chosen = sparse[doc]
        yield texts.mix(plain[chosen] + _KINDS[2]), doc[chosen], 1
        fewer, g = neighbours(sparse[d])
        yield texts.mix(fewer + _KINDS[2]), doc[g], 1
        for x in np.flatnonzero(sparse):
            filled = part[first[x] : first[x] + n_filled[x]]
            empty = np.setdiff1d(np.arange(segments[x], dtype=np.uint64), filled)
            bare = texts.mix(band[[x]].astype(np.uint64) * _BAND + empty * _SEGMENT)
            yield texts.mix(texts.mix(bare) + _KINDS[2]), np.full(len(empty), x), 1


def _among(frequent: np.ndarray, found: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(found), bool)
    place = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
    return frequent[place] == found


def signatures(
    docs: DataFrame,
    frequent: list[int],
    words: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    everything: bool = False,
) -> DataFrame:
    """(signature, salt, doc_id); the salt is 0 for signatures that any document may write."""
    bands = Bands(percent)
    known = docs.sparkSession.sparkContext.broadcast(np.array(sorted(frequent), np.int64))

    def run(batches):
        common = np.sort(known.value.view(np.uint64))
        for batch in batches:
            for ids, hashes, owner in _sets(batch, words):
                for signed, doc, some in sign(hashes, owner, len(ids), bands, common, everything):
                    if len(signed):
                        chosen = ids[doc]
                        salt = np.zeros(len(doc), np.int32)
                        if some:
                            spread = texts.mix(chosen.astype(np.int64).view(np.uint64))
                            salt = (spread % np.uint64(SALTS)).astype(np.int32) + 1
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(signed.view(np.int64)), pa.array(salt), pa.array(chosen, pa.int64())],
                            ["signature", "salt", "doc_id"],
                        )

    return docs.mapInArrow(lean(run), "signature long, salt int, doc_id long")


def frequent_signatures(docs: DataFrame, words: int, percent: int) -> list[int]:
    """Signatures that many documents share, by a fixed share of the documents."""
    some = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE_SHARE)) == 0)
    found = (
        signatures(some, [], words, percent, everything=True)
        .groupBy("signature")
        .count()
        .filter(F.col("count") >= FREQUENT)
        .orderBy(F.desc("count"), "signature")
        .limit(MOST_FREQUENT)
        .select("signature")
    )
    return found.toArrow().column(0).to_pylist()


def _refuted(batches, percent: int):
    """Drop pairs that sizes or histograms refute; tell equal sets."""
    for batch in batches:
        names = batch.schema.names
        size_a, size_b, same = (
            batch.column(names.index(c)).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b", "same")
        )
        sides = [
            np.frombuffer(b"".join(batch.column(names.index(c)).to_pylist()), "<u2")
            .reshape(-1, BUCKETS)
            .astype(np.int32)
            for c in ("histogram_a", "histogram_b")
        ]
        apart = np.abs(sides[0] - sides[1]).sum(axis=1)
        allowed = (100 - percent) * (size_a + size_b) // (100 + percent)
        keep = pa.array((apart <= allowed) & (size_a > 0) & (size_b > 0))
        yield pa.RecordBatch.from_arrays(
            [batch.column(names.index("a")), batch.column(names.index("b")), pa.array(same, pa.bool_())],
            ["a", "b", "same"],
        ).filter(keep)


def _agreeing(batches, percent: int):
    for batch in batches:
        left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        keep = []
        for x, y in zip(left, right):
            p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(p, q, assume_unique=True))
            keep.append(100 * both >= percent * (len(p) + len(q) - both))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1)], ["a", "b"]
        ).filter(pa.array(keep, pa.bool_()))


def _whole_sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(doc_id, shingles) of some documents, ascending 64-bit hashes."""

    def sets(batches):
        for batch in batches:
            for own, hashes, owner in _sets(batch, words):
                cuts = np.searchsorted(owner, np.arange(len(own) + 1))
                blobs = [hashes[cuts[i] : cuts[i + 1]].tobytes() for i in range(len(own))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int64()), pa.array(blobs, pa.binary())], ["doc_id", "shingles"]
                )

    some = lookup_join(docs, staged(ids, "jaccard-ids"), ["doc_id"], "left_semi")
    return some.mapInArrow(lean(sets), "doc_id long, shingles binary")


def verified(
    pairs: DataFrame, docs: DataFrame, known: DataFrame, words: int, percent: int
) -> DataFrame:
    """The pairs (a, b) that are linked, as a table in the shared folder."""

    def side(letter: str) -> DataFrame:
        return known.select(
            F.col("doc_id").alias(letter),
            F.col("n_shingles").alias(f"n_{letter}"),
            F.struct("n_shingles", "sum_a", "sum_b").alias(f"set_{letter}"),
            F.col("histogram").alias(f"histogram_{letter}"),
        )

    both = (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .withColumn("same", F.col("set_a") == F.col("set_b"))
        .select("a", "b", "n_a", "n_b", "same", "histogram_a", "histogram_b")
    )
    left = staged(
        both.mapInArrow(lean(lambda x: _refuted(x, percent)), "a long, b long, same boolean").distinct(),
        "jaccard-candidates",
    )
    unequal = left.filter(~F.col("same")).select("a", "b")
    ids = unequal.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    whole = _whole_sets(docs, ids, words)
    compared = (
        unequal.join(whole.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
        .join(whole.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b")
        .select("a", "b", "x", "y")
        .mapInArrow(lean(lambda x: _agreeing(x, percent)), "a long, b long")
    )
    return staged(left.filter("same").select("a", "b").unionByName(compared), "jaccard-links")


def _meetings(rows: DataFrame) -> DataFrame:
    """Rows of signatures that more than one document wrote, with the smallest id of their group.

    No group of the window is large: frequent signatures are not among the unsalted ones, and the
    others are dealt to many salts.
    """
    group = Window.partitionBy("signature", "salt")
    return (
        rows.withColumn("least", F.min("doc_id").over(group))
        .withColumn("most", F.max("doc_id").over(group))
        .filter((F.col("least") < F.col("most")) | (F.col("salt") > 0))
        .select("signature", "salt", "doc_id", "least")
    )


def _first_pairs(met: DataFrame) -> DataFrame:
    """Each document with the smaller one that it shares most signatures with."""
    heads = met.filter("salt > 0").select("signature", F.col("least").alias("doc_id")).distinct()
    smallest = F.min("doc_id").over(Window.partitionBy("signature"))
    pairs = met.select("least", "doc_id").unionByName(
        heads.withColumn("least", smallest).select("least", "doc_id")
    )
    return (
        pairs.filter("least < doc_id")
        .groupBy("least", "doc_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("doc_id")
        .agg(F.max(F.struct("n", F.bitwise_not("least").alias("inverted"))).alias("best"))
        .select(F.bitwise_not("best.inverted").alias("a"), F.col("doc_id").alias("b"))
    )


def _torn(met: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the signatures that meet several components, with their own and the largest.

    Components only merge, so a later round needs none but these rows.
    """
    roots = labels.withColumnRenamed("u", "doc_id")

    def rooted(rows: DataFrame) -> DataFrame:
        found = F.coalesce("root", "doc_id").alias("root")
        return rows.join(roots, "doc_id", "left").select(*rows.columns, found).distinct()

    held = met.select("signature", "doc_id")
    shares = rooted(held).groupBy("signature", "root").agg(F.count(F.lit(1)).alias("n"))
    parts = (
        shares.groupBy("signature")
        .agg(
            F.max(F.struct("n", "root")).alias("main"),
            F.sum("n").alias("members"),
            F.count(F.lit(1)).alias("parts"),
        )
        .filter("parts > 1")
        .select(
            "signature",
            F.col("main.root").alias("main"),
            "members",
        )
    )
    torn = lookup_join(held, staged(parts, "jaccard-parts"), ["signature"], "inner", LOOKUP_BYTES)
    return staged(rooted(torn), "jaccard-torn")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _everyone(labels: DataFrame) -> DataFrame:
    """(main, doc_id) of all components of two documents or more."""
    return labels.select(F.col("root").alias("main"), F.col("u").alias("doc_id")).unionByName(
        labels.select(F.col("root").alias("main"), F.col("root").alias("doc_id")).distinct()
    )


def _families(torn: DataFrame, everyone: DataFrame) -> DataFrame:
    """(main, doc_id, meetings): strays that meet a component and the strays around it in far more
    rows than it has members."""
    sizes = everyone.groupBy("main").agg(F.count(F.lit(1)).alias("size"))
    return staged(
        torn.filter("root <> main")
        .groupBy("main", "doc_id")
        .agg(F.sum("members").alias("meetings"))
        .filter(F.col("meetings") >= FAMILY)
        .join(sizes, "main", "left")
        .filter("meetings > coalesce(size, 1)")
        .select("main", "doc_id", "meetings"),
        "jaccard-families",
    )


def _inside(families: DataFrame, everyone: DataFrame) -> DataFrame:
    """(main, doc_id, stray) of the families: the component's members, and its strays."""
    mains = families.select("main").distinct()
    members = (
        everyone.join(mains, "main", "left_semi")
        .unionByName(mains.withColumn("doc_id", F.col("main")))
        .distinct()
    )
    strays = families.select("main", "doc_id").withColumn("stray", F.lit(True))
    return members.withColumn("stray", F.lit(False)).unionByName(strays)


def _pivot_pairs(families: DataFrame, everyone: DataFrame, turn: int) -> DataFrame:
    """Each stray with a few members and a few other strays of the family it meets most."""
    lot = F.xxhash64("doc_id", F.lit(turn))
    closest = (
        families.groupBy("doc_id")
        .agg(F.max(F.struct("meetings", "main")).alias("best"))
        .select(F.col("best.main").alias("main"), "doc_id")
    )
    pivots = (
        _inside(closest, everyone).groupBy("main", "stray", F.pmod(lot, F.lit(PIVOTS)))
        .agg(F.min(F.struct(lot.alias("lot"), "doc_id")).alias("p"))
        .select("main", F.col("p.doc_id").alias("b"))
    )
    pairs = closest.select("main", F.col("doc_id").alias("a")).join(pivots, "main").filter("a <> b")
    return _ordered(pairs)


def _block_links(
    families: DataFrame, everyone: DataFrame, docs: DataFrame, words: int, percent: int
) -> DataFrame:
    """Links of the families' strays with members and with each other, block by block."""
    inside = _inside(families, everyone)
    ids = inside.select("doc_id").distinct()
    held = staged(inside.join(_whole_sets(docs, ids, words), "doc_id"), "jaccard-family-sets")
    n_bytes = F.octet_length("shingles") + 64
    blocks = lambda of: F.greatest(F.ceil(F.sum(F.when(of, n_bytes)) / BLOCK_BYTES), F.lit(1))
    # One row per family, so that dealing its documents into blocks needs no shuffle by family.
    counts = held.groupBy("main").agg(
        blocks(F.col("stray")).alias("stray_blocks"), blocks(~F.col("stray")).alias("member_blocks")
    )
    packed = staged(
        lookup_join(held, staged(counts, "jaccard-family-sizes"), ["main"], "inner")
        .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.expr("if(stray, stray_blocks, member_blocks)")))
        .groupBy("main", "stray", "block", "stray_blocks", "member_blocks")
        .agg(F.collect_list("doc_id").alias("ids"), F.collect_list("shingles").alias("sets")),
        "jaccard-blocks",
    )
    # Pairs of block numbers are dealt by block before the sets join them, not by family.
    others = "filter(sequence(0L, stray_blocks - 1), b -> b >= block)"
    numbers = packed.filter("stray").select(
        "main",
        F.col("block").alias("at"),
        F.expr(
            f"explode(concat(transform({others}, b -> struct(true AS stray, b AS block)), "
            "transform(sequence(0L, member_blocks - 1), b -> struct(false AS stray, b AS block)))) AS other"
        ),
    ).select("main", "at", "other.*")
    right = packed.select("main", "stray", "block", F.col("ids").alias("y"), F.col("sets").alias("q"))
    left = packed.filter("stray").select("main", F.col("block").alias("at"), F.col("ids").alias("x"), F.col("sets").alias("p"))
    pairs = numbers.join(right, ["main", "stray", "block"]).join(left, ["main", "at"])
    return staged(
        pairs.select("x", "p", "y", "q").mapInArrow(lean(lambda x: _linked_in_blocks(x, percent)), "a long, b long"),
        "jaccard-links",
    )


def _linked_in_blocks(batches, percent: int):
    for batch in batches:
        for x, p, y, q in zip(*(batch.column(i) for i in range(4))):
            a, b = np.array(x.as_py(), np.int64), np.array(y.as_py(), np.int64)
            left, right = ([np.frombuffer(v, np.uint64) for v in side.as_py()] for side in (p, q))
            shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
            both = _held(left, shared) @ _held(right, shared).T
            sizes = np.add.outer([len(v) for v in left], [len(v) for v in right])
            i, j = np.nonzero((both > 0) & (100 * both >= percent * (sizes - both)))
            i, j = i[a[i] != b[j]], j[a[i] != b[j]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(a[i], b[j])), pa.array(np.maximum(a[i], b[j]))], ["a", "b"]
            )


def _held(sets: list[np.ndarray], shared: np.ndarray) -> np.ndarray:
    """Which of the shared shingles each set holds."""
    out = np.zeros((len(sets), len(shared)), np.float32)
    for row, own in zip(out, sets):
        row[np.isin(shared, own, assume_unique=True)] = 1
    return out


def _cross_pairs(torn: DataFrame, families: DataFrame) -> DataFrame:
    """Members of one signature that lie in different components, but for strays of the signature's
    family, which are compared in blocks."""
    strays = torn.filter("root <> main").join(families.select("main", "doc_id"), ["main", "doc_id"], "left_anti")
    others = torn.select("signature", F.col("doc_id").alias("b"), F.col("root").alias("root_b"))
    pairs = strays.select("signature", F.col("doc_id").alias("a"), "root").join(others, "signature")
    return _ordered(pairs.filter("root <> root_b"))


def _labels(links: DataFrame) -> DataFrame:
    return star_labels(links.select(F.col("a").alias("u"), F.col("b").alias("v")))


def jaccard_components(
    documents: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): ``n_shingles`` and ``component_id``.

    The component is the smallest doc_id reachable by links, the document itself included. Texts
    without words have no shingles and no links. Rows that share a doc_id count as one document:
    the links of any of them are its links. A null doc_id is an id below all others and comes back
    as null. Other columns are ignored.
    """
    docs = documents.select(_id().alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = staged(sketches(docs, words), "jaccard-sketches")
    frequent = frequent_signatures(docs, words, percent)
    met = staged(_meetings(signatures(docs, frequent, words, percent)), "jaccard-meetings")
    links = verified(_first_pairs(met), docs, known, words, percent)
    labels = _labels(links)
    for turn in range(1, ROUNDS + 2):
        torn, everyone = _torn(met, labels), _everyone(labels)
        met = torn
        families = _families(torn, everyone)
        if turn > ROUNDS or families.isEmpty():
            break
        more = verified(_pivot_pairs(families, everyone, turn), docs, known, words, percent)
        if more.isEmpty():
            break
        links = links.unionByName(more)
        labels = _labels(links)
    links = links.unionByName(verified(_cross_pairs(torn, families), docs, known, words, percent))
    if not families.isEmpty():
        links = links.unionByName(_block_links(families, everyone, docs, words, percent))
    labels = _labels(links).select(F.col("u").alias("doc_id"), "root")
    found = F.coalesce("root", "doc_id")
    real = lambda c: F.when(c != NULL_ID, c)
    return known.join(labels, "doc_id", "left").select(
        real(F.col("doc_id")).alias("doc_id"), "n_shingles", real(found).alias("component_id")
    )
