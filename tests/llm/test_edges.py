"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import itertools
import math
import random
from re import _constants as sre
from re import _parser

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from riskloom.llm import (
    chunk_recipes, decontamination, jaccard, licenses, lines, packing, personal_data, perspectives,
    queries, toxicity, url_rules,
)
from test_contracts import check_packing

#: Columns whose names the operators use themselves.
CLASHING = ["mark", "hits", "n_words", "places", "share", "task", "personal", "toxicity", "root", "keyword"]


def prose(seed, n, letters="abcdefgh"):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(n))


LONG = prose(1, 30_000)
DOCS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "ONE"), (6, LONG), (7, LONG), (8, LONG + " tail"),
    (9, prose(2, 300)), (10, prose(2, 300).upper()), (11, "a b c d"), (12, "a b c d"), (13, "KİÉ été\x00x"),
    (14, "Copyright 2020. All rights\n\nreserved, CC--BY 4.0; GNU General Public License v3"),
    (15, "mail a@b.c_x@d.e from 1.2.3.4.5 and 300.1.1.1 card 4111 1111 1111 1111, +1 (212) 555-0100."),
    (16, "shared line of text\nown\n\tSHARED line of text \nshared line of text"),
    (17, "shared line of text\n" + prose(3, 40)), (18, "\U0001f600 emoji \U0001f600@x.y\U0001f600 10.0.0.1"),
    (19, "9" * 50_000), (20, "1 " * 20_000), (21, "a@" * 20_000), (22, "x." * 20_000 + "@" + "b." * 20_000 + "c"),
    (23, prose(2, 299) + " zz"), (24, "IBAN GB82 WEST 1234 5698 7654 32 account"),
]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3)
    return frame.withColumns({name: F.lit("x") for name in CLASHING})


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and repeated rows."""
    rows = [(None, "null id text here now"), (1, "null id text here now"), (1, "null id text here now"), (1, "other"), (None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def by_id(df, *columns):
    return {r[0]: tuple(r)[1:] for r in df.select(*columns).collect()}


def test_jaccard(docs, odd):
    got = by_id(jaccard.jaccard_components(docs), "doc_id", "n_shingles", "component_id")
    assert got == brute.jaccard(DOCS)
    rows = jaccard.jaccard_components(odd).collect()
    assert len(rows) == 5 and {r.component_id for r in rows} == {None}


def test_exact(docs, odd):
    found = chunk_recipes.exact_duplicates(docs)
    assert by_id(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute.exact(DOCS)
    rows = chunk_recipes.exact_duplicates(odd).collect()
    assert sorted((r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in rows if r.group_size == 3) == [
        (0, 1, 3, False), (1, 1, 3, True), (1, 1, 3, True)
    ]
    assert len(rows) == 5


def test_colliding_chunk_keys(docs):
    collided = chunk_recipes.exact_duplicates(docs, key_bits=2)
    assert by_id(collided, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute.exact(DOCS)


def test_lines(docs, odd):
    found = lines.drop_shared_lines(docs).withColumn("sha", F.sha2("kept", 256))
    assert by_id(found, "doc_id", "n_lines", "n_dropped", "sha") == brute.lines(DOCS)
    rows = lines.drop_shared_lines(odd).collect()
    assert sorted((r.doc_id or 0, r.n_dropped) for r in rows) == [(0, 0), (0, 0), (1, 0), (1, 1), (1, 1)]


def test_lines_of_three_documents(docs):
    got = by_id(lines.drop_shared_lines(docs, min_docs=3), "doc_id", "n_dropped")
    assert got[17] == (0,) and got[7] == (0,)


def test_licenses(docs, odd):
    found = licenses.license_scan(docs)
    got = by_id(found, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert got == {i: brute.licenses(t) for i, t in DOCS}
    labels = by_id(found, "doc_id", "labels", "score")[14]
    assert set(labels[0].split(",")) >= {"reserved", "cc-by-4.0", "gpl-3.0"} and labels[1] > 0.5
    assert licenses.license_scan(odd).count() == 5


def test_license_rules_are_tried_only_with_their_keyword():
    known = licenses.rules()
    assert len(known) > 300
    assert all(rule.keyword in rule.pattern for rule in known)


def forms(parsed):
    """Strings that a pattern matches: every alternative, optional parts left out and present."""
    out = [""]
    for op, arg in parsed:
        if op is sre.LITERAL:
            tails = [chr(arg)]
        elif op is sre.SUBPATTERN:
            tails = forms(arg[3])
        elif op is sre.BRANCH:
            tails = [form for part in arg[1] for form in forms(part)]
        elif op is sre.IN and all(o is sre.LITERAL for o, _ in arg):
            tails = [chr(a) for _, a in arg]
        elif op in (sre.IN, sre.NOT_LITERAL):
            tails = ["1" if arg[0][0] is sre.RANGE else "x"]
        else:
            assert op in (sre.MAX_REPEAT, sre.POSSESSIVE_REPEAT), op
            least, most, inner = arg
            counts = {least, min(most, max(least, 1)), min(most, least + 1)}
            tails = ["".join(p) for n in counts for p in itertools.product(forms(inner), repeat=n if n < 3 else 1)]
        out = [head + tail for head in out for tail in dict.fromkeys(tails)]
    return out


def test_every_match_of_a_license_rule_holds_its_keyword_as_a_word():
    for rule in licenses.rules():
        for form in forms(_parser.parse(rule.pattern)):
            assert f" {rule.keyword} " in f" {form} ", (rule, form)


@pytest.mark.parametrize("keyless", [False, True])
def test_licenses_without_the_word_license(spark, keyless):
    texts = {
        "Released under the BSD 3-Clause.": "bsd-3-clause",
        "BSD 2-Clause, see below": "bsd-2-clause",
        "old BSD 4 clause terms": "bsd-4-clause",
        "released into the public under The Unlicense": "unlicense",
        "MIT No Attribution": "mit-0",
        "Creative Commons Zero": "cc0-1.0",
        "for noncommercial use only": "non-commercial",
        "for non-commercial purposes": "non-commercial",
        "GNU General Public License3": "gpl-3.0",
    }
    # A second text holds the words that used to be the keywords.
    tail = "" if keyless else "\nlicense licence commercial"
    frame = spark.createDataFrame([(i, t + tail) for i, t in enumerate(texts)], "doc_id long, text string")
    got = by_id(licenses.license_scan(frame), "doc_id", "labels")
    for i, label in enumerate(texts.values()):
        assert label in got[i][0].split(","), (i, label, got[i])


def test_personal_data(docs, odd):
    rows = personal_data.personal_data(docs).collect()
    for r in rows:
        listed = brute.personal(r.text)[1]
        base = [f"{s.kind}:{s.start}:{s.end}" for s in r.personal if s.kind in personal_data.BASE_KINDS]
        assert base == listed
    assert "iban" in {s.kind for r in rows if r.doc_id == 24 for s in r.personal}
    assert personal_data.personal_data(odd).count() == 5


def test_account_numbers_end_at_their_countrys_length(spark):
    german, plain, british = "DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"
    texts = [
        (f"IBAN {german} BIC COBADEFF", [german]), (f"{plain} I paid", [plain]), (f"{plain} 2024 paid", [plain]),
        (f"{plain}, then", [plain]), (f"{german} {british} OK", [german, british]), (f"ZZ12 {german}", [german]),
        ("NO93 8601 1117 947 NOK", ["NO93 8601 1117 947"]), (f"{plain}7", []), (f"X{plain}", []),
        ("DE88 3704 0044 0532 0130 00", []),
    ]
    frame = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    for r in personal_data.personal_data(frame).collect():
        found = [r.text[s.start : s.end] for s in r.personal if s.kind == "iban"]
        assert found == texts[r.doc_id][1], r.text


def test_personal_data_on_random_signs(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choices("0123456789.@+- ()aB_%é", weights=[6] * 10 + [8, 4, 3, 6, 8, 2, 2, 5, 5, 2, 2, 1], k=400)) for _ in range(150)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in personal_data.personal_data(frame).collect():
        base = [f"{s.kind}:{s.start}:{s.end}" for s in r.personal if s.kind in personal_data.BASE_KINDS]
        assert base == brute.personal(r.text)[1], r.text


def test_decontamination(spark, docs, odd):
    items = [(1, prose(2, 300)[100:220]), (2, "all rights reserved"), (3, "ONE"), (4, None), (5, ""), (6, "all rights reserved"), (7, "text here")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("mark", F.lit(1))
    for size in (decontamination.BLOCK_BYTES, 300):
        rows = decontamination.contamination(docs, bench, block_bytes=size).collect()
        got = {r.doc_id: (r.n_words, r.n_hit, sorted(map(str, r["items"]))) for r in rows}
        want = brute.contamination(DOCS, items)
        assert len(rows) == len(DOCS)
        for i, (n_words, n_hit, n_items, names, _) in want.items():
            assert got[i][:2] == (n_words, n_hit) and brute.sha(",".join(got[i][2])) == names
        assert sorted(r.n_hit for r in decontamination.contamination(odd, bench, block_bytes=size).collect()) == [0, 0, 2, 2, 2]
    none = decontamination.contamination(docs, bench.filter("item_id > 10"))
    assert none.filter("n_hit > 0").count() == 0


def test_packing(docs, odd):
    encode = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER)).encode
    ids = {i: np.array([*encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t in DOCS}
    check_packing(packing.harmonic_packing(docs, public_tokenizers.path(queries.TOKENIZER)).collect(), ids)
    small = packing.harmonic_packing(docs, public_tokenizers.path(queries.TOKENIZER), capacity=64).collect()
    check_packing(small, ids, 64)
    rows = packing.harmonic_packing(odd, public_tokenizers.path(queries.TOKENIZER)).collect()
    assert len(rows) == 5 and {r.doc_id for r in rows} == {None, 1}


class Reads(dict):
    """A dictionary that counts how often it is asked for a key."""

    count = 0

    def __contains__(self, key):
        Reads.count += 1
        return super().__contains__(key)

    def __getitem__(self, key):
        Reads.count += 1
        return super().__getitem__(key)

    def get(self, key, default=None):
        Reads.count += 1
        return super().get(key, default)


def test_packing_looks_up_distinct_words_only():
    words = packing.WordTokenizer(public_tokenizers.path(queries.TOKENIZER))
    for name, held in list(vars(words).items()):
        if isinstance(held, dict):
            setattr(words, name, Reads(held))
    Reads.count = 0
    found = words.ids(pa.array(["Straße, été (x) don't " * 5_000, "été\n" * 5_000]))
    assert 0 < Reads.count < 100
    encode = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER)).encode
    assert found[1].tolist() == encode("été", add_special_tokens=False).ids * 5_000


def test_packing_words_match_the_tokenizer(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_PIECES", 500)
    rng = random.Random(5)
    signs = [*"aBzÀÿßµ×÷İΣſǅ漢٣7'.,-!?|\x00\t\r\n \u00a0\u2003\u0301\U0001f600", "  ", "'s", "'LL", "...", "<|endoftext|>"]
    texts = ["", " ", "\n\n", "A" * 3_000, "É." * 3_000, "x" + "!" * 3_000]
    texts += ["".join(rng.choices(signs, k=rng.randint(1, 60))) for _ in range(2_000)]
    texts += [prose(i, 50, "aéÖn").title() + "," for i in range(50)]
    words = packing.WordTokenizer(public_tokenizers.path(queries.TOKENIZER))
    encode = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER)).encode
    want = [encode(t, add_special_tokens=False).ids for t in texts]
    for step in (1, 7, 700):
        rows = pa.array(["before", *texts, "after"])[1:-1]
        runs = [words.ids(rows[i : i + step]) for i in range(0, len(rows), step)]
        assert [own.tolist() for run in runs for own in run] == want
    assert words.ids(rows[:0]) == []


@pytest.mark.parametrize("length", [1, 2, 100, 1365, 1366, 2047, 2048, 3000, 4095, 4096, 4097, 100_000])
def test_cuts_cover_a_document(length):
    pieces = packing.cuts(length)
    assert sum(pieces) == length and min(pieces) > 0 and max(pieces) <= packing.CAPACITY


def test_urls(spark):
    urls = [
        None, "", "no scheme", "http://ORG/x", "http://a.Example.org/es/1?q=/en/1", "http://example.org/en/12", "http://com/fr/",
        "http://x.com/fr", "https://example.org", "http://example.org?x", "http://notorg/", "http://a.b.c.d.e.example.org/es/", "http://.org/", "://org/", "http://org/#a",
        "http://org/\x01/", "http://x.orgé/", "http://co.com/de/",
    ]
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(urls * 3)], "page_id long, url string")
    frame = frame.withColumns({"host": F.lit(1), "rule": F.lit(2), "key": F.lit(3), "_rest": F.lit("kept")})
    assert {r._rest for r in url_rules.judge(frame, spark.createDataFrame(queries.URL_RULES, "rule string, verdict string")).collect()} == {"kept"}
    rules = spark.createDataFrame(queries.URL_RULES, "rule string, verdict string")
    got = by_id(url_rules.judge(frame, rules), "page_id", "host", "path", "rule", "verdict")
    assert got == {i: brute.url(u) for i, u in enumerate(urls * 3)}
    assert url_rules.judge(frame, rules.limit(0)).filter("rule IS NULL").count() == len(urls) * 3
    assert url_rules.judge(frame.limit(0), rules).count() == 0


def test_urls_against_many_nested_rules(spark):
    rng = random.Random(9)
    names = ["a", "b", "ab", "a-b"]
    host = lambda n: ".".join(rng.choice(names) for _ in range(n))
    path = lambda: "/" + "/".join(rng.choice("xyz") for _ in range(rng.randint(0, 3)))
    rules = sorted({(host(rng.randint(1, 3)) + path(), rng.choice(["allow", "block"])) for _ in range(400)})
    rules = list(dict(rules).items())
    pages = [(i, f"http://{host(rng.randint(1, 5))}{path()}") for i in range(1500)]
    got = by_id(
        url_rules.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(rules, "rule string, verdict string")),
        "page_id", "host", "path", "rule", "verdict",
    )
    assert got == {i: brute.url(u, rules) for i, u in pages}


def test_perspectives(spark):
    turns = [
        (1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None), (1, 2, "bob", None), (1, 3, "cy", "é!"),
        (2, 0, "system", "alone"), (None, None, "ann", "x"), (3, None, None, "y"), (3, 5, "ann", "z"),
    ]
    turns += [(4, i, "ab"[i % 2], f"m{i}") for i in range(600)]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("segment", F.lit(9))
    rows = perspectives.perspectives(frame).collect()
    views = {(r.conv_id, r.perspective, r.segment): r for r in rows}
    assert {k[:2] for k in views} == {(1, "ann"), (1, "bob"), (1, "cy"), (None, "ann"), (3, ""), (3, "ann"), (4, "a"), (4, "b")}
    bob = views[1, "bob", 0]
    assert bob.text.startswith("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>user name=ann\nhi <\\|im_end|><|im_end|>\n")
    assert bob.n_messages == 5 and bob.n_own == 2
    for r in rows:
        spans = [tuple(map(int, s.split(":"))) for s in r.mask.split(",")] if r.mask else []
        assert len(spans) == r.n_own
        for a, b in spans:
            assert r.text[:a].endswith("<|im_start|>assistant\n") and r.text[a:b].endswith("<|im_end|>")
    assert [views[4, "a", s].n_messages for s in range(3)] == [256, 256, 88]
    assert [views[4, "a", s].first_place for s in range(3)] == [0, 256, 512]
    assert "".join(views[4, "a", s].text for s in range(3)).count("<|im_start|>assistant") == 300


def test_toxicity(spark, docs, odd):
    rng = random.Random(3)
    rows = [(i, prose(i, 60) + (" vileword" + rng.choice("xyz") if i % 6 == 0 else "")) for i in range(900)]
    train = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(900)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.train(train, labels)
    got = {r.doc_id: r.toxicity for r in toxicity.score(train, model).collect()}
    assert all((got[i] >= 0.5) == (i % 6 == 0) for i in got)
    scored = toxicity.score(docs, model)
    assert scored.count() == len(DOCS) and set(scored.columns) == set(docs.columns)
    assert all(0 <= r.toxicity <= 1 for r in scored.collect())
    assert toxicity.score(odd, toxicity.train(train, labels.filter("toxic = 0"))).filter("toxicity >= 0.5").count() == 0


def test_toxicity_with_confirmed_toxic_labels_only(spark):
    """Half of the toxic texts are confirmed, nothing else is labelled."""
    rows = [(i, prose(i, 60) + (" vileword" + "xyz"[i % 3] if i % 8 == 0 else "")) for i in range(2000)]
    train = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(0, 2000, 16)], "doc_id long, toxic int")
    scores = toxicity.score(train, toxicity.train(train, labels)).collect()
    assert all((r.toxicity >= 0.5) == (r.doc_id % 8 == 0) for r in scores)


@pytest.mark.parametrize("shift", [0.0, -4.0])
def test_slope_is_the_gradient_of_the_risk(shift):
    """Against differences of the plainly written risk; where the clean part is negative, of that part alone."""
    rng = np.random.default_rng(1)
    p = (rng.random((60, 9)) < 0.5).astype(float)
    u = (rng.random((150, 9)) < 0.3).astype(float)
    p[:, -1] = u[:, -1] = 1
    prior = 0.3

    def loss(rows, w, sign):
        return sum(math.log1p(math.exp(-sign * sum(x * y for x, y in zip(row, w)))) for row in rows) / len(rows)

    def clean(w):
        return loss(u, w, -1) - prior * loss(p, w, -1)

    w = rng.normal(size=9)
    if shift:
        # Positives above all, the rest far below: the estimate falls below zero.
        p[:, 0], u[:, 0] = 1, 0
        w[:] = 0
        w[0], w[-1] = 9.0, shift
    assert (clean(w) < 0) == bool(shift)
    aim = (lambda v: -clean(v)) if shift else (lambda v: prior * loss(p, v, 1) + clean(v))
    near = np.eye(9) * 1e-6
    plain = [(aim(w + e) - aim(w - e)) / 2e-6 for e in near]
    assert np.allclose(toxicity.slope(p, u, w, prior), plain, atol=1e-7)


def test_telling_cells_by_plain_counts(spark):
    rng = np.random.default_rng(5)
    rows = [(i, int(i % 4 == 0), sorted({int(c) for c in rng.integers(0, 60, 20)} | ({100 + i % 8} if i % 4 == 0 else set()))) for i in range(800)]
    held = spark.createDataFrame(rows, "doc_id long, kind int, cells array<int>")
    tests = {}
    for cell in {c for row in rows for c in row[2]}:
        a, b = (sum(cell in r[2] for r in rows if r[1] == kind) for kind in (1, 0))
        p, u = (a + 0.5) / 201, (b + 0.5) / 601
        tests[cell] = abs(p - u) / math.sqrt(p / 201 + u / 601)
    wanted = sorted(c for c, t in tests.items() if t > 4)
    assert toxicity._telling_cells(held, 200, 600, toxicity.PuPolicy()).tolist() == wanted == [100, 104]
    assert toxicity._telling_cells(held, 200, 600, toxicity.PuPolicy(words_kept=1)).tolist() == [100]


def test_groups_beyond_the_broadcast_bound(spark, docs, monkeypatch):
    """Hot keys leave the shuffle; results stay the same."""
    from riskloom.operators import joins

    for module in (chunk_recipes, lines, url_rules):
        monkeypatch.setattr(module, "LOOKUP_BYTES", 0)
    many = [(100 + i, "copied many times over, a line of its own") for i in range(60)]
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame(many, "doc_id long, text string"))
    held = [*DOCS, *many]
    split = joins.hot_split_join
    monkeypatch.setattr(joins, "hot_split_join", lambda *a, **k: split(*a, **k, min_hot_rows=10))
    found = chunk_recipes.exact_duplicates(more)
    assert by_id(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute.exact(held)
    found = lines.drop_shared_lines(more).withColumn("sha", F.sha2("kept", 256))
    assert by_id(found, "doc_id", "n_lines", "n_dropped", "sha") == brute.lines(held)
    pages = [(i, ["http://example.org/es/1", None, "http://com/fr/", "http://x.org/"][i % 4 if i > 40 else 0]) for i in range(80)]
    rules = spark.createDataFrame(queries.URL_RULES, "rule string, verdict string")
    got = by_id(url_rules.judge(spark.createDataFrame(pages, "page_id long, url string"), rules), "page_id", "host", "path", "rule", "verdict")
    assert got == {i: brute.url(u) for i, u in pages}


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    rules = spark.createDataFrame(queries.URL_RULES, "rule string, verdict string")
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert jaccard.jaccard_components(none).count() == 0
    assert chunk_recipes.exact_duplicates(none).count() == 0
    assert lines.drop_shared_lines(none).count() == 0
    assert licenses.license_scan(none).count() == 0
    assert packing.harmonic_packing(none, public_tokenizers.path(queries.TOKENIZER)).count() == 0
    assert personal_data.personal_data(none).count() == 0
    assert decontamination.contamination(none, bench).count() == 0
    assert url_rules.judge(spark.createDataFrame([], "page_id long, url string"), rules).count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert perspectives.perspectives(turns).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(none, toxicity.train(none, labels)).count() == 0


def test_pipeline_against_plain_stages(spark):
    """Every stage on its predecessor's documents, with plain versions of the exact ones."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        held = [(r.doc_id, r.text) for r in docs.collect()]
        after = stage(spark, docs, folder)
        if name != "packing":
            assert set(after.columns) == set(docs.columns)
            kept = {r.doc_id for r in after.select("doc_id").collect()}
        if name == "exact_dedup":
            assert kept == {i for i, x in brute.exact(held).items() if x[2]}
        if name == "ngram_jaccard":
            assert kept == {i for i, x in brute.jaccard(held).items() if x[1] == i}
        if name == "decontamination":
            assert kept == {i for i, x in brute.contamination(held, items).items() if not x[4]}
        if name == "packing":
            assert {r.doc_id for r in after.collect()} == {i for i, _ in held}
        docs = after


def test_pipeline_drops_rows_of_null_and_repeated_ids(spark, tmp_path):
    near = prose(41, 300)
    item = prose(42, 40)
    rows = [
        (None, "alone"), (None, "copied"), (7, "copied"), (8, "twice"), (8, "twice"), (None, "null twice"), (None, "null twice"),
        (9, "copied"), (9, "clean one"), (20, near), (None, near + " more"), (21, near + " end"), (21, "clean two"),
        (30, "words " + item), (30, "clean three"), (None, item), (31, item + " x"), (40, None), (40, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    seen = {}
    for name in ("exact_dedup", "ngram_jaccard", "decontamination"):
        docs = stages[name](spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang"]
        seen[name] = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=str)
    want = {
        (None, "alone"), (9, "copied"), (8, "twice"), (None, "null twice"), (9, "clean one"), (20, near),
        (None, near + " more"), (21, near + " end"), (21, "clean two"), (30, "words " + item), (30, "clean three"),
        (None, item), (31, item + " x"), (40, ""),
    }
    assert seen["exact_dedup"] == sorted(want, key=str)
    # Near copies: null is the smallest id.
    want -= {(20, near), (21, near + " end"), (30, "words " + item), (31, item + " x")}
    assert seen["ngram_jaccard"] == sorted(want, key=str)
    want -= {(None, item)}
    assert seen["decontamination"] == sorted(want, key=str)
