"""Linked sets share a signature, whatever is frequent."""

import brute
import numpy as np
import pytest

from riskloom.llm import jaccard, texts
from riskloom.operators import joins


def signed(sets, bands, frequent):
    hashes = np.concatenate([np.sort(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    out = [set() for _ in sets]
    for sigs, docs, _ in jaccard.sign(hashes, owner, len(sets), bands, frequent):
        for s, d in zip(sigs.tolist(), docs.tolist()):
            out[d].add(s)
    return out


@pytest.mark.parametrize("percent", [80, 90])
@pytest.mark.parametrize("share", [0.0, 0.3, 0.9, 1.0])
def test_linked_pairs_meet(percent, share):
    rng = np.random.default_rng(int(percent + 10 * share))
    bands = jaccard.Bands(percent)
    pairs = []
    for size in [*range(1, 60), *rng.integers(60, 900, 60).tolist()]:
        for _ in range(12):
            base = texts.mix(rng.integers(0, 1 << 62, size, dtype=np.uint64))
            most = size * (100 - percent) // 80 + 1
            gone = int(rng.integers(0, most))
            more = int(rng.integers(0, most))
            other = np.concatenate([base[gone:], texts.mix(rng.integers(0, 1 << 62, more, dtype=np.uint64))])
            both = size - gone
            if len(other) and 100 * both >= percent * (size + len(other) - both):
                pairs.append((base, other))
    sets = [s for pair in pairs for s in pair]
    everything = [
        s
        for sigs, _, _ in jaccard.sign(
            np.concatenate([np.sort(s) for s in sets]), np.repeat(np.arange(len(sets)), [len(s) for s in sets]),
            len(sets), bands, np.zeros(0, np.uint64), True,
        )
        for s in sigs.tolist()
    ]
    chosen = np.array(sorted(x for x in set(everything) if (x >> 7) % 1000 < share * 1000), np.uint64)
    found = signed(sets, bands, chosen)
    assert len(pairs) > 300
    for k in range(len(pairs)):
        assert found[2 * k] & found[2 * k + 1], (len(pairs[k][0]), len(pairs[k][1]))


def test_few_signatures_meet_by_chance():
    rng = np.random.default_rng(3)
    sets = [texts.mix(rng.integers(0, 1 << 62, n, dtype=np.uint64)) for n in rng.integers(30, 400, 300)]
    found = signed(sets, jaccard.Bands(80), np.zeros(0, np.uint64))
    written = sum(len(x) for x in found)
    assert written < 0.45 * sum(len(s) for s in sets)
    assert len(set().union(*found)) == written


def test_families_in_blocks(spark, monkeypatch):
    """Strays compared block by block give the links of plain comparison, each once per pair of blocks."""
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", 4000)
    rng = np.random.default_rng(7)
    base = [f"w{i}" for i in rng.integers(0, 10**6, 60)]
    rows = []
    for i in range(80):
        words = list(base)
        for at in rng.integers(0, 60, i % 4):
            words[at] = f"x{rng.integers(0, 10**6)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # Two families share the documents: one of members and strays, one of strays alone.
    families = spark.createDataFrame(
        [(0, i, 9999) for i in range(50, 80)] + [(45, i, 9999) for i in range(46, 60)], "main long, doc_id long, meetings long"
    )
    everyone = spark.createDataFrame([(0, i) for i in range(50)], "main long, doc_id long")
    found = [(r.a, r.b) for r in jaccard._block_links(families, everyone, docs, 5, 80).collect()]
    sets = {i: brute.shingles(text) for i, text in rows}

    def linked(a, b):
        return 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])

    wanted = {(min(a, b), max(a, b)) for a in range(50, 80) for b in range(80) if a != b and linked(a, b)}
    wanted |= {(min(a, b), max(a, b)) for a in range(46, 60) for b in range(45, 60) if a != b and linked(a, b)}
    assert set(found) == wanted and wanted


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_torn_signatures(spark, monkeypatch, limit):
    """Equal to a plain count, by broadcast or by a shuffle without its hot keys; the torn rows of one
    round are enough for the next."""
    monkeypatch.setattr(jaccard, "LOOKUP_BYTES", limit)
    split = joins.hot_split_join
    monkeypatch.setattr(joins, "hot_split_join", lambda *a, **k: split(*a, **k, min_hot_rows=10))
    rng = np.random.default_rng(3)
    rows = [(int(s), int(d)) for s, d in zip(rng.integers(0, 40, 150), rng.integers(0, 60, 150))]
    rows += [(100, d) for d in range(60)] + [(101, d) for d in range(0, 60, 10)] + rows[:5]
    met = spark.createDataFrame(rows, "signature long, doc_id long")

    def plain(roots):
        held = {}
        for signature, doc in set(rows):
            held.setdefault(signature, []).append((doc, roots.get(doc, doc)))
        out = set()
        for signature, docs in held.items():
            sizes = {}
            for _, root in docs:
                sizes[root] = sizes.get(root, 0) + 1
            if len(sizes) > 1:
                main = max((n, root) for root, n in sizes.items())[1]
                out |= {(signature, doc, root, main, len(docs)) for doc, root in docs}
        return out

    def found(rows, roots):
        labels = spark.createDataFrame(sorted(roots.items()), "u long, root long")
        torn = jaccard._torn(rows, labels)
        got = [(r.signature, r.doc_id, r.root, r.main, r.members) for r in torn.collect()]
        assert len(got) == len(set(got))
        return torn, set(got)

    first = {d: d // 10 * 10 for d in range(60) if d % 10}
    torn, got = found(met, first)
    assert got == plain(first) and len({s for s, *_ in got}) < len({s for s, _ in rows})
    merged = {d: d // 30 * 30 for d in range(60) if d % 30}
    assert found(torn, merged)[1] == plain(merged)
