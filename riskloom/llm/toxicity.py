"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic texts are used as labels; the unlabelled side is drawn from all training texts,
labelled or not, and holds an unknown number of toxic ones. With the class prior p, the risk of a classifier g is

    p * R_P(g, +1) + max(0, R_U(g, -1) - p * R_P(g, -1)),

the second term being an estimate of the risk on clean texts, which cannot be negative (Kiryo, Niu,
du Plessis, Sugiyama, "Positive-unlabeled learning with non-negative risk estimator", 2017). Where
the estimate falls below zero, its gradient is reversed.

The classifiers are linear in the words that a text holds, hashed to a fixed number of cells, and
are averaged. They are fitted in numpy on a bounded sample; scoring runs over all documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import texts
from riskloom.llm.folders import staged
from riskloom.llm.memory import lean

CELLS = 1 << 20
#: Bytes at the start of a word that are features beside the whole word.
PREFIXES = (4, 5, 6)


@dataclass(frozen=True)
class PuPolicy:
    """Bounds and settings of the training.

    ``most_positive`` and ``most_unlabelled`` bound the sample that is fitted on; it is drawn by a
    hash of the document id. ``folds`` keeps the documents whose crc32(id) is divisible by it out.
    ``prior`` is the share of toxic texts to assume where the labels hold no clean row to tell it.
    """

    most_positive: int = 4000
    most_unlabelled: int = 8000
    folds: int = 5
    models: int = 3
    steps: int = 200
    rate: float = 0.05
    decay: float = 1e-4
    least_documents: int = 5
    words_kept: int = 400
    prior: float = 0.1


def held_out(doc_id, folds: int = 5):
    return F.crc32(doc_id.cast("string").cast("binary")) % folds == 0


def word_cells(column: pa.Array):
    """For runs of texts: number of texts, the cells of their words and of the words' first bytes,
    the texts' numbers. Insults are inflected, so a stem may be all that two words share."""
    for first, last, data, bounds in texts.text_chunks(column):
        starts, ends, owner = texts.word_bounds(data, bounds, texts.ALPHANUMERIC)
        cells, owners = [texts.word_hashes(data, starts, ends)], [owner]
        for length in PREFIXES:
            long = ends - starts >= length
            salt = np.uint64(length)
            cells.append(texts.mix(texts.word_hashes(data, starts[long], starts[long] + length) + salt))
            owners.append(owner[long])
        yield last - first, (np.concatenate(cells) % np.uint64(CELLS)).astype(np.int64), np.concatenate(owners)


def _cells(batches):
    """doc_id and kind with the distinct cells of the text."""
    for batch in batches:
        lists = []
        for n, cells, owner in word_cells(batch.column(2)):
            both = np.unique(owner * CELLS + cells)
            cut = np.searchsorted(both, np.arange(n + 1) * CELLS)
            lists += [(both[cut[i] : cut[i + 1]] % CELLS).astype(np.int32) for i in range(n)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int32()))], ["doc_id", "kind", "cells"]
        )


def _thinned(df: DataFrame, most: int) -> DataFrame:
    """About ``most`` of the rows at most, by a hash of the id; never more than a tenth above it."""
    total = df.count()
    if total <= most:
        return df
    part = int(most / total * (1 << 30))
    return df.filter(F.pmod(F.xxhash64("doc_id", F.lit("pu")), F.lit(1 << 30)) < part).limit(most + most // 10)


class Fitted:
    """The cells that tell, their weights for each classifier, and the intercepts."""

    def __init__(self, cells: np.ndarray, weights: np.ndarray, intercepts: np.ndarray):
        self.cells, self.weights, self.intercepts = cells, weights, intercepts

    def columns(self) -> np.ndarray:
        """For each cell its number among those that tell, else -1."""
        column = np.full(CELLS, -1, np.int32)
        column[self.cells] = np.arange(len(self.cells))
        return column

    def scores(self, n: int, cells: np.ndarray, owner: np.ndarray, columns: np.ndarray) -> np.ndarray:
        at = columns[cells]
        width = max(1, len(self.cells))
        held = np.unique(owner[at >= 0] * width + at[at >= 0])
        logits = np.stack(
            [
                np.bincount(held // width, w[held % width], minlength=n) + b
                for w, b in zip(self.weights, self.intercepts)
            ]
        )
        return (1 / (1 + np.exp(-np.clip(logits, -30, 30)))).mean(axis=0)


def _telling_cells(held: DataFrame, n_p: int, n_u: int, policy: PuPolicy) -> np.ndarray:
    """Cells that positives hold far more or less often than unlabelled texts, by their log-odds test.

    ``held`` has kind and cells of each text of the sample. Texts per cell are counted in Spark; only
    the ``words_kept`` best cells come to the driver. Ties go to the smaller cell.
    """
    seen = held.select("kind", F.explode("cells").alias("cell")).groupBy("cell").agg(
        F.count_if(F.col("kind") == 1).alias("p"), F.count_if(F.col("kind") == 0).alias("u")
    )
    rate_p, rate_u = (F.col("p") + 0.5) / (n_p + 1), (F.col("u") + 0.5) / (n_u + 1)
    test = F.abs(rate_p - rate_u) / F.sqrt(rate_p / (n_p + 1) + rate_u / (n_u + 1))
    best = (
        seen.filter(F.col("p") + F.col("u") >= policy.least_documents)
        .select("cell", test.alias("test")).filter("test > 4")
        .orderBy(F.desc("test"), "cell").limit(policy.words_kept)
    )
    return np.sort(np.array([row.cell for row in best.collect()], np.int64))


def slope(p: np.ndarray, u: np.ndarray, w: np.ndarray, prior: float) -> np.ndarray:
    """Direction of descent of the non-negative risk at weights ``w``.

    ``p`` and ``u`` are the positive and unlabelled texts as rows. It is the gradient of the risk
    where the estimate of the clean texts' risk is not negative, else minus that estimate's gradient.
    """
    z_p, z_u = (p @ w).astype(np.float64), (u @ w).astype(np.float64)
    at_p, at_u = 1 / (1 + np.exp(-z_p)), 1 / (1 + np.exp(-z_u))
    risk = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
    at_p, at_u = at_p.astype(p.dtype), at_u.astype(u.dtype)
    clean = u.T @ at_u / len(u) - prior * (p.T @ at_p) / len(p)
    return prior * (p.T @ (at_p - 1)) / len(p) + clean if risk >= 0 else -clean


def fit(positive, unlabelled, chosen: np.ndarray, prior: float, policy: PuPolicy) -> Fitted:
    """Linear classifiers with the least non-negative risk, by Adam with a seed each.

    Each side is the cells of its texts, the texts' numbers, and their count; only the ``chosen``
    cells count.
    """
    (_, _, n_p), (_, _, n_u) = positive, unlabelled
    if not n_p or not n_u:
        return Fitted(np.zeros(0, np.int64), np.zeros((policy.models, 0)), np.full(policy.models, -4.0))
    sides = [side[:2] for side in (positive, unlabelled)]
    column = np.full(CELLS, -1)
    column[chosen] = np.arange(len(chosen))
    dense = []
    for (cells, owner), n in zip(sides, (n_p, n_u)):
        x = np.zeros((n, len(chosen) + 1), np.float32)
        x[:, -1] = 1
        inside = column[cells] >= 0
        x[owner[inside], column[cells[inside]]] = 1
        dense.append(x)
    weights, intercepts = np.zeros((policy.models, len(chosen))), np.zeros(policy.models)
    for k in range(policy.models):
        rng = np.random.default_rng(k)
        # Each classifier sees its own draw of the sample.
        p = dense[0][rng.integers(0, n_p, n_p)] if k else dense[0]
        u = dense[1][rng.integers(0, n_u, n_u)] if k else dense[1]
        w = np.zeros(len(chosen) + 1, np.float32)
        w[-1] = np.log(prior / (1 - prior))
        mean, square = np.zeros_like(w), np.zeros_like(w)
        for step in range(1, policy.steps + 1):
            down = slope(p, u, w, prior) + policy.decay * np.append(w[:-1], 0)
            mean = 0.9 * mean + 0.1 * down
            square = 0.999 * square + 0.001 * down * down
            w -= np.float32(policy.rate) * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        weights[k], intercepts[k] = w[:-1], w[-1]
    return Fitted(chosen, weights, intercepts)


def train(documents: DataFrame, labels: DataFrame, policy: PuPolicy = PuPolicy()) -> Fitted:
    """Fit on the training folds: confirmed toxic texts against texts of all training documents.

    ``labels`` has doc_id and toxic; only rows with toxic = 1 are used as labels, and the share of
    those among the labelled training rows as the class prior, or ``policy.prior`` where all of them
    are toxic. Documents without id or text and labels without id or value are left out. Without
    positives every score is low.
    """
    usable = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
    known = (
        usable.filter(~held_out(F.col("doc_id"), policy.folds))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    n_toxic, n_known = known.agg(F.count_if(F.col("toxic") == 1), F.count(F.lit(1))).first()
    prior = min(max(n_toxic / n_known if n_toxic < n_known else policy.prior, 1e-3), 0.5)
    readable = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).filter("doc_id IS NOT NULL AND text IS NOT NULL")
    training = readable.filter(~held_out(F.col("doc_id"), policy.folds)).select("doc_id").distinct()
    toxic = _thinned(known.filter("toxic = 1").select("doc_id"), policy.most_positive)
    any_of = _thinned(training, policy.most_unlabelled)
    # The samples are bounded by the policy, so their ids may be broadcast.
    drawn = toxic.withColumn("kind", F.lit(1)).unionByName(any_of.withColumn("kind", F.lit(0)))
    held = staged(
        readable.join(F.broadcast(drawn.select(F.col("doc_id").cast("long").alias("doc_id"), "kind")), "doc_id")
        .select("doc_id", "kind", "text")
        .mapInArrow(lean(_cells), "doc_id long, kind int, cells array<int>"),
        "toxicity-sample",
    )
    n_p, n_u = held.agg(F.count_if(F.col("kind") == 1), F.count_if(F.col("kind") == 0)).first()
    chosen = _telling_cells(held, n_p, n_u, policy)
    told = F.array_intersect("cells", F.array(*map(F.lit, chosen.tolist())).cast("array<int>"))
    rows = held.select("doc_id", "kind", told.alias("cells")).toArrow().combine_chunks()
    return fit(_side(rows, 1), _side(rows, 0), chosen, prior, policy)


def _side(rows: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The telling cells of the texts of one kind, the texts' numbers in the order of their ids, and their count."""
    own = rows.filter(pc.equal(rows["kind"], kind))
    lists = own.take(pc.sort_indices(own, [("doc_id", "ascending")]))["cells"].combine_chunks()
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    cells = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return cells, np.repeat(np.arange(len(lengths)), lengths), len(lengths)


def score(documents: DataFrame, model: Fitted, output: str = "toxicity") -> DataFrame:
    """All columns of ``documents`` with the score from 0 to 1 as ``output``, in place of one of that name.

    A null text is an empty one. Rows are scored one by one.
    """
    documents = documents.drop(output)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    names = documents.columns
    at = names.index("text")

    def run(batches):
        columns = shared.value.columns()
        for batch in batches:
            found = [shared.value.scores(*x, columns) for x in word_cells(batch.column(at))]
            values = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values, pa.float64())], [*names, output]
            )

    schema = documents.withColumn(output, F.lit(0.0)).schema
    return documents.mapInArrow(lean(run), schema)
