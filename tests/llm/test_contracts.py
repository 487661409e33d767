"""The queries on the smallest tables against plain versions."""

import os
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskloom.llm import packing, queries, toxicity

FOLDER = os.environ.get("LLM_TEST_FOLDER", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")
    docs = [(r.doc_id, r.text) for r in read("documents").select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in read("benchmark").collect()]
    return docs, items


def rows(spark, name, *columns):
    found = queries.all_queries()[name](spark, FOLDER).select(*columns).collect()
    keys = [r[0] for r in found]
    assert len(keys) == len(set(keys))
    return {r[0]: tuple(r)[1:] for r in found}


def test_jaccard(spark, tables):
    assert rows(spark, "op2_jaccard", "doc_id", "n_shingles", "component_id") == brute.jaccard(tables[0])


def test_exact(spark, tables):
    got = rows(spark, "op3_chunk_recipes", "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == brute.exact(tables[0])


def test_lines(spark, tables):
    got = rows(spark, "op4_shared_lines", "doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert got == brute.lines(tables[0])


def test_licenses(spark, tables):
    got = rows(spark, "op5_licenses", "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert got == {i: brute.licenses(t) for i, t in tables[0]}


def test_personal_data(spark, tables):
    got = rows(spark, "op7_personal_data", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
    for i, t in tables[0]:
        digest, listed = brute.personal(t)
        assert got[i][:5] == digest
        assert set(listed) <= set(got[i][5].split(","))


def test_decontamination(spark, tables):
    got = rows(
        spark, "op8_decontamination", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )
    assert got == brute.contamination(*tables)


def test_urls(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url").collect()
    got = rows(spark, "op9_url_rules", "page_id", "host", "path", "rule", "verdict")
    assert got == {r.page_id: brute.url(r.url) for r in pages}


def test_packing(spark, tables):
    encode = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER)).encode
    ids = {i: np.array([*encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t in tables[0]}
    found = queries.op6_harmonic_packing(spark, FOLDER).collect()
    check_packing(found, ids)
    total = sum(len(x) for x in ids.values())
    n = len({r.sequence_id for r in found})
    assert n * packing.CAPACITY <= total * 1.05 + 2 * packing.CAPACITY


def check_packing(found, ids, capacity=4096):
    pieces, sequences = {}, {}
    for r in found:
        assert r.length > 0
        assert r.doc_tokens == len(ids[r.doc_id])
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert len(own) == r.length and zlib.crc32(own.tobytes()) == r.ids_crc32
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(ids)
    for i, own in pieces.items():
        assert_gapless(own)
        assert sum(n for _, n in own) == len(ids[i])
    for own in sequences.values():
        assert_gapless(own)
        assert sum(n for _, n in own) <= capacity


def assert_gapless(pieces):
    at = 0
    for start, length in sorted(pieces):
        assert start == at
        at += length


def test_toxicity_on_held_out_rows(spark):
    folder = FOLDER.replace("sf0.001", "sf0.1")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = queries.op10_toxicity(spark, folder).collect()
    assert {r.held_out for r in got} == {True, False}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    known = [(r.score, labels[r.doc_id]) for r in got if r.held_out and labels.get(r.doc_id) is not None]
    order = np.argsort([s for s, _ in known], kind="stable")
    truth = np.array([t for _, t in known])[order]
    ranks = np.arange(1, len(truth) + 1)
    n_p, n_n = truth.sum(), (truth == 0).sum()
    area = (ranks[truth == 1].sum() - n_p * (n_p + 1) / 2) / (n_p * n_n)
    right = np.mean([(s >= 0.5) == t for s, t in known])
    caught = np.mean([s >= 0.5 for s, t in known if t == 1])
    print("area", area, "accuracy", right, "caught", caught)
    assert area > 0.9 and right > 0.93 and caught > 0.7
