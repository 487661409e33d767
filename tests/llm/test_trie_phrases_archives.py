"""The prefix trie, phrase collocations and archives against plain versions, and at their edges."""

import base64
import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import pytest
import zstandard
from pyspark.sql import functions as F

from riskloom.llm import collocations, prefix_trie, queries, warc
from riskloom.llm.prefix_trie import NODE

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TURNS = "conv_id long, turn long, role string, text string"


# --- prefix trie --------------------------------------------------------------------------------


def plain_rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), role, hashlib.sha256(text.encode()).digest(), text))
    turns = {c: [(role, text) for _, role, _, text in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        source = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = turns.get(source, [])[:h] + turns[c][h:]
    return out


def plain_trie(sequences):
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in sequences.items():
        ends[tuple(turns)].append(c)
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
    children = Counter(node[:-1] for node in members if node)
    saved, leaves = Counter(), Counter()
    for node, held in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(held) - 1) * (len(node[-1][1]) if node else 0)
            leaves[node[:d]] += not children[node]
    return {
        (min(held), len(node)): (
            min(members[node[:-1]]) if node else None, len(held), children[node], leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, held in members.items()
    }


def found_trie(trie):
    digests = prefix_trie.list_digests(trie.end_lists)
    empty = hashlib.sha256(b"").hexdigest()
    rows = trie.nodes.join(digests, NODE, "left").collect()
    got = {
        (r.conv_id, r.depth): (
            r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256 or empty
        )
        for r in rows
    }
    assert len(got) == len(rows)
    return got


def turn_rows():
    rng = random.Random(11)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "ccc", "", None, "é\U0001f600"]))
            for c in range(330) for t in range(rng.randint(1, 7)) if c not in (0, 100)]
    rows += [(0, 0, "user", "only"), (400, None, "user", "null first"), (400, -1, "user", "x"), (400, 2, "user", "tie"),
             (400, 2, "user", "tie"), (400, 2, "assistant", "tie"), (-5, 0, "user", "neg"), (-100, 1, "system", "below")]
    rows += [(500 + i, t, "user", text) for i in range(60) for t, text in enumerate(("same", "same", "same", "same", "same", "x"))]
    rows += [(700, t, "user", f"turn {t % 3}") for t in range(1200)] + [(701, t, "user", f"turn {t % 3}") for t in range(1150)]
    rows += [(None, 1, "user", "no conversation"), (900, 1, "user", "L" * 60_000), (901, 1, "user", "L" * 60_000)]
    return rows


def test_trie_equals_a_plain_one(spark):
    rows = turn_rows()
    frame = spark.createDataFrame(rows, TURNS).repartition(5).withColumns({"depth": F.lit(1), "run": F.lit("x"), "high": F.lit(2)})
    ids, sequences = prefix_trie.rebuilt(frame)
    sequences = sequences.persist()
    want = plain_rebuilt(rows)
    assert {r.conv_id for r in ids.collect()} == set(want)
    assert any(not turns for turns in want.values()) and max(map(len, want.values())) > 1000
    trie = prefix_trie.prefix_trie(ids, sequences)
    got = found_trie(trie)
    assert got == plain_trie(want)
    turns = prefix_trie.with_last_turns(trie, frame).filter("depth > 0").collect()
    assert {(r.conv_id, r.depth): (r.role, r.text) for r in turns} == {
        (c, d): want[c][d - 1] for c, d in got if d
    }


def test_end_lists_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "LIST_BLOCK", 7)
    rows = [(c, t, "user", "same") for c in range(0, 5000, 10) for t in range(8)]
    trie = prefix_trie.prefix_trie(*prefix_trie.rebuilt(spark.createDataFrame(rows, TURNS).repartition(3)))
    assert trie.end_lists.agg(F.max(F.size("conv_ids"))).first()[0] <= 7
    assert found_trie(trie) == plain_trie(plain_rebuilt(rows))


def test_trie_without_conversations(spark):
    none = spark.createDataFrame([], TURNS)
    trie = prefix_trie.prefix_trie(*prefix_trie.rebuilt(none))
    assert trie.nodes.count() == 0 and prefix_trie.list_digests(trie.end_lists).count() == 0


# --- phrases ------------------------------------------------------------------------------------


def plain_phrases(docs, top, least=10):
    counts, sizes = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for n in (1, 2, 3):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        known = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in known.items():
            if any(q[i : i + len(p)] == p for q, b in known.items() if len(q) > len(p) and 100 * b >= 50 * a for i in (0, 1)):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), a, f[p[:k]], f[p[k:]]))
        for rank, (score, _, phrase, a, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), a, left, right, sizes[lang], -score))
    return sorted(out)


def found_phrases(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def made_docs(seed, n_docs=150, n_words=40, langs=("en", "de", None, "und")):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 4))) for _ in range(n_words)]
    docs = []
    for i in range(n_docs):
        parts = []
        for _ in range(rng.randint(0, 120)):
            word = words[min(int(rng.expovariate(0.15)), n_words - 1)]
            parts.append(rng.choice([word, word.upper(), "new york city", "new york", "ab ab ab"]) + rng.choice([" ", "  ", "\t", " ", ", ", ".", "\n", "\x0b"]))
        docs.append((langs[i % len(langs)], "".join(parts)))
    return docs + [("en", None), ("fr", ""), ("en", "one"), (None, ".,;"), ("en", "w" * 50_000 + " x")]


@pytest.mark.parametrize("top", [1, 7, 2000])
def test_phrases_equal_plain_ones(spark, top):
    docs = made_docs(1)
    frame = spark.createDataFrame(docs, "lang string, text string").repartition(4)
    frame = frame.withColumns({"x": F.lit(1), "a": F.lit("a"), "score": F.lit(0), "doc_id": F.lit(None).cast("long")})
    got = found_phrases(collocations.collocations(frame, top=top))
    assert got == plain_phrases(docs, top) and got


@pytest.mark.parametrize("swallowed", [50, 95])
def test_thresholds_are_lowered_until_enough_survive(spark, monkeypatch, swallowed):
    """The best pairs are swallowed, so the first rounds settle nothing."""
    monkeypatch.setattr(collocations, "FIRST_REACH", 1)
    rng = random.Random(4)
    triples = [[f"{c}{i}" for c in "xyz"] for i in range(60)]
    docs = [("en", ". ".join(" ".join(t) for t in triples) + ". " + " ".join(rng.choice("abcd") for _ in range(50))) for _ in range(12)]
    rounds = []
    thresholds = collocations._thresholds
    monkeypatch.setattr(collocations, "_thresholds", lambda *a: rounds.append(a[2]) or thresholds(*a))
    frame = spark.createDataFrame(docs, "lang string, text string")
    assert found_phrases(collocations.collocations(frame, top=70)) == plain_phrases(docs, 70)
    assert len(rounds) > 2


def test_long_texts_are_counted_in_runs(spark, monkeypatch):
    monkeypatch.setattr(collocations, "RUN_WORDS", 5)
    docs = made_docs(9, 40)
    frame = spark.createDataFrame(docs, "lang string, text string")
    # The functions that run in the tasks are sent with the setting.
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(collocations)
    try:
        assert found_phrases(collocations.collocations(frame, top=50)) == plain_phrases(docs, 50)
    finally:
        cloudpickle.unregister_pickle_by_value(collocations)


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 10**12 + 7, 10**12 + 9, 10**12 + 11
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(collocations._score("a", "l", "r"))
    assert row.first()[0] == 1_000_000 * a * a // (left * right)


def test_no_phrases(spark):
    schema = "lang string, text string"
    assert collocations.collocations(spark.createDataFrame([], schema)).count() == 0
    assert collocations.collocations(spark.createDataFrame([("en", "too few words")], schema)).count() == 0


# --- archives -----------------------------------------------------------------------------------

BIG, HUGE = "<html>" + "é" * 600, "<p>" + "x" * 300_000
PAGES = [
    (1, "http://a/", BIG), (2, "http://b/?q=%20\r\nX: y", BIG), (3, None, BIG), (4, "u", "small"), (5, "u", "small"),
    (6, "", None), (7, "http://ü/\U0001f600", ""), (8, "h", HUGE), (9, "h", "y" * 1000), (9, "h", "y" * 1000), (10, "h", "z" * 999),
    (11, "h", "z" * 999), (12, "h", "\r\n\r\nWARC/1.1\r\n\r\n" * 80), (None, "n", BIG), (13, "h", "\x00\x01" * 600), (0, "h", HUGE),
]


@pytest.fixture(scope="module")
def pages(spark):
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)
    return frame.withColumns({"payload": F.lit(1), "keep_id": F.lit(2), "sha1": F.lit("s"), "archive": F.lit("a")})


def plain_pages():
    held = defaultdict(list)
    for page, _, html in PAGES:
        held[html or ""].append(page)
    out = []
    for page, url, html in PAGES:
        data = (html or "").encode()
        keep = max((p for p in held[html or ""] if p is not None), default=None)
        revisit = len(data) >= 1000 and page != keep
        out.append((page, url, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
                    keep if revisit else None, None if revisit else data))
    return sorted(out, key=str)


@pytest.mark.parametrize("archive_bytes", [1, 1 << 20])
def test_archives_round_trip(spark, pages, tmp_path, archive_bytes):
    folder = str(tmp_path / "warc")
    rows = warc.archived(pages, folder, archive_bytes=archive_bytes).collect()
    got = [(r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
            None if r.payload is None else bytes(r.payload)) for r in rows]
    assert sorted(got, key=str) == plain_pages()
    files = list((tmp_path / "warc").glob("*.warc.zst"))
    assert len(files) == (len(PAGES) if archive_bytes == 1 else len(files)) and files


def test_archives_follow_the_format(spark, pages, tmp_path):
    many = spark.range(400).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.repeat(F.sha2(F.col("id").cast("string"), 256), 3), F.lit("<html><body class=main>")).alias("html"))
    dictionary = warc.trained_dictionary(many)
    assert dictionary[:4] == b"\x37\xa4\x30\xec"
    warc.write_archives(many, str(tmp_path), dictionary).collect()
    n_records = 0
    for path in tmp_path.glob("*.warc.zst"):
        data = path.read_bytes()
        magic, size = struct.unpack("<II", data[:8])
        assert magic == 0x184D2A5D and zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]) == dictionary
        decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        at = 8 + size
        while at < len(data):
            frame = decoder.decompressobj()
            raw = frame.decompress(data[at:])
            assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n") and raw.count(b"WARC-Type") == 1
            at = len(data) - len(frame.unused_data)
            n_records += 1
    assert n_records == 400


def test_archives_left_behind_are_not_read(spark, pages, tmp_path):
    (tmp_path / "part-lost.warc.zst").write_bytes(b"cut short")
    assert warc.archived(pages, str(tmp_path)).count() == len(PAGES)
    faults = warc.read_archives(spark, str(tmp_path)).filter("problem IS NOT NULL").collect()
    assert [r.archive for r in faults] == ["part-lost.warc.zst"]


def test_no_pages(spark, pages):
    assert warc.archived(pages.limit(0)).count() == 0


GOOD = warc.record(5, "http://a/", b"payload", None, False, "2000-01-01T00:00:00Z")
VISIT = warc.record(5, None, b"payload", 9, True, "2000-01-01T00:00:00Z")


def changed(raw, old, new):
    assert old in raw
    return raw.replace(old, new)


def test_records_are_parsed():
    digest = hashlib.sha1(b"payload").hexdigest()
    assert warc.parsed(GOOD) == (5, "http://a/", "response", None, b"payload", 7, digest)
    assert warc.parsed(VISIT) == (5, None, "revisit", 9, None, 7, digest)


@pytest.mark.parametrize("raw", [
    b"", b"WARC/1.0\r\n\r\n", GOOD[:-1], GOOD + b"x", changed(GOOD, b"payload\r\n", b"payloaD\r\n"), changed(GOOD, b"WARC-Type", b"WARC-Kind"),
    changed(GOOD, b"WARC-Date: 2000-01-01T00:00:00Z\r\n", b""), changed(GOOD, b"WARC-Record-ID: ", b"WARC-Record-ID "),
    changed(GOOD, b"<urn:x-page:5>", b"<urn:x-page:>"), changed(GOOD, b"msgtype=response\r\nContent-Length: ", b"msgtype=response\r\nContent-Length: -"),
    changed(GOOD, b"msgtype=response\r\n", b"msgtype=response\r\nContent-Length: 1\r\n"), changed(VISIT, b"WARC-Refers-To: <urn:x-page:9>\r\n", b""),
    changed(VISIT, b"identical-payload-digest", b"server-not-modified"), changed(GOOD, b"WARC-Payload-Digest: sha1:", b"WARC-Payload-Digest: md5:"),
    changed(changed(GOOD, b"utf-8\r\nContent-Length: 7", b"utf-8\r\nContent-Length: 8"), base64.b32encode(hashlib.sha1(GOOD.split(b"\r\n\r\n", 1)[1][:-4]).digest()), base64.b32encode(hashlib.sha1(GOOD.split(b"\r\n\r\n", 1)[1][:-4].replace(b"Length: 7", b"Length: 8")).digest())),
])
def test_faulty_records_are_refused(raw):
    with pytest.raises(ValueError):
        warc.parsed(raw)


def test_faulty_frames_are_told():
    pack = zstandard.ZstdCompressor(write_checksum=True).compress
    good = pack(GOOD) + pack(VISIT)
    assert [(raw, fault) for _, raw, fault in warc.frames(good)] == [(GOOD, None), (VISIT, None)]
    assert [fault for *_, fault in warc.frames(b"")] == []
    for bad in (good[:-3], good + b"x", good[:-1] + bytes([good[-1] ^ 1])):
        faults = [fault for *_, fault in warc.frames(bad)]
        assert faults[0] is None and faults[-1] is not None
    for head in (struct.pack("<II", 0x184D2A5D, 10**6), struct.pack("<II", 0x184D2A5D, 5) + struct.pack("<I", 0xFD2FB528) + b"x"):
        assert [fault is None for *_, fault in warc.frames(head + good)] == [False]


def test_queries_against_plain_versions(spark):
    folder = "/root/testdata/sf0.001"
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    docs = [(r.lang, r.text) for r in read("documents").collect()]
    got = sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in queries.op12_collocations(spark, folder).collect())
    assert got == plain_phrases(docs, 2000)
    turns = [(r.conv_id, r.turn, r.role, r.text) for r in read("conversations").collect()]
    trie = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in queries.op11_prefix_trie(spark, folder).collect()}
    assert trie == plain_trie(plain_rebuilt(turns))
    assert queries.op13_warc(spark, folder).count() == read("pages").count()
