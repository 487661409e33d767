import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom.functions import text as txt
from riskloom.functions.splitting import split_text
from riskloom.operators import chunking, conversations

FILES = conversations.FILES_HEADING
ALPHABET = "ab \n\t é😀"


def documents(spark, texts):
    rows = [("p", f"f{i}.txt", i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "project_id string, source string, doc_id int, text string")


def sample_texts():
    rng = random.Random(3)
    texts = ["", "x", "😀" * 501, "a" * 499, "b" * 500, "c" * 501, "d" * 950, "e" * 951, None]
    texts += ["".join(rng.choices(ALPHABET, k=rng.randint(1, 3000))) for _ in range(20)]
    return texts


@pytest.mark.parametrize("size, overlap", [(500, 50), (10, 5), (100, 1)])
def test_fixed_chunks_equal_slices(spark, size, overlap):
    texts = sample_texts()
    got = {}
    for row in chunking.chunk_fixed(documents(spark, texts), size, overlap).collect():
        got.setdefault(row.doc_id, {})[row.chunk_no] = row.text
    for i, text in enumerate(texts):
        stride, want = size - overlap, {}
        for n, start in enumerate(range(0, max(len(text or ""), 1), stride)):
            if text and (n == 0 or len(text) - start > overlap):
                want[n] = text[start : start + size]
        assert got.get(i, {}) == want


def test_fixed_chunks_reject_a_large_overlap(spark):
    with pytest.raises(ValueError):
        chunking.chunk_fixed(documents(spark, ["x"]), 100, 60)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abc \n", max_size=400), st.integers(5, 40))
def test_recursive_chunks_keep_every_word_in_order(text, size):
    chunks = split_text(text, size, 0)
    assert all(0 < len(c) <= size for c in chunks)
    assert all(c == c.strip() for c in chunks)
    assert "".join("".join(chunks).split()) == "".join(text.split())


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abc \n", max_size=400), st.integers(10, 40), st.integers(1, 9))
def test_recursive_chunks_with_overlap(text, size, overlap):
    at = 0
    for chunk in split_text(text, size, overlap):
        assert len(chunk) <= size
        found = text.find(chunk, max(0, at - overlap - size))
        assert found >= 0
        at = found + len(chunk)
    assert "".join(text.split())[-1:] == "".join(text[:at].split())[-1:]


def test_recursive_chunks_prefer_paragraphs():
    text = "uno dos\n\n" + "tres " * 3 + "\n\ncuatro"
    assert split_text(text, 20, 0) == ["uno dos", "tres tres tres", "cuatro"]
    assert split_text("aaaa bbbb cccc dddd", 10, 5) == ["aaaa bbbb", "bbbb cccc", "cccc dddd"]
    assert split_text("abcdefghij", 4, 1) == ["abcd", "defg", "ghij"]


def test_recursive_chunks_on_spark(spark):
    texts = ["línea uno\n\nlínea dos " * 100, "", None, "corto"]
    got = {}
    rows = chunking.chunk_recursive(documents(spark, texts)).collect()
    for row in sorted(rows, key=lambda r: r.chunk_no):
        got.setdefault(row.doc_id, []).append(row.text)
    assert got == {i: split_text(t) for i, t in enumerate(texts) if t}
    counts = chunking.chunk_counts(chunking.chunk_recursive(documents(spark, texts)))
    assert {r.source: r.n_chunks for r in counts.collect()} == {
        f"f{i}.txt": len(split_text(t)) for i, t in enumerate(texts) if t
    }


def test_word_count_equals_python_split(spark):
    texts = ["", "  ", "a b", " a b\x1cc\x85d　", "uno\n\ndos\ttres ", "é😀 x"]
    texts += [t for t in sample_texts() if t]
    got = documents(spark, texts).select(
        "doc_id", txt.word_count(F.col("text")).alias("n"), txt.text_statistics(F.col("text")).alias("s")
    )
    for row in got.collect():
        text = texts[row.doc_id]
        assert row.n == len(text.split())
        assert row.s == (
            f"El fragmento tiene {len(text.split())} palabras y {len(text)} caracteres "
            "(incluyendo espacios)."
        )


def test_source_lines(spark):
    rows = [("a/b/c.pdf", 3), ("a/b/c.txt", None), (None, None)]
    df = spark.createDataFrame(rows, "source string, page int")
    got = [r[0] for r in df.select(txt.source_line(F.col("source"), F.col("page"))).collect()]
    assert got == ["- c.pdf (Pág. 3)", "- c.txt", "- Documento desconocido"]


def test_formatted_now_and_money(spark):
    row = spark.range(1).select(txt.formatted_now().alias("t"), txt.money(F.lit(1234567.891)).alias("m"))
    got = row.first()
    assert len(got.t) == 19 and got.t[10] == " " and got.m == "1234567.89"


def messages(spark, conversations_of_words):
    rows = [
        (c, t, "user" if t % 2 == 0 else "assistant", "w " * n)
        for c, sizes in conversations_of_words.items()
        for t, n in enumerate(sizes)
    ]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


@pytest.mark.parametrize("block", [2, 1000])
def test_history_window_keeps_the_longest_suffix(spark, block):
    sizes = {1: [5, 5, 5, 5], 2: [100, 1], 3: [3], 4: [50], 5: [10, 0, 0]}
    got = conversations.history_window(messages(spark, sizes), limit=10, block=block).collect()
    kept = {}
    for row in got:
        if not row.to_summarise:
            kept.setdefault(row.conv_id, set()).add(row.turn)
    assert kept == {1: {2, 3}, 2: {1}, 3: {0}, 5: {0, 1, 2}}


def test_last_questions_and_prompts(spark):
    sizes = {1: [1, 2, 3, 4], 2: [1]}
    history = messages(spark, sizes)
    asked = conversations.last_questions(history).withColumnRenamed("conv_id", "query_id")
    assert {(r.query_id, r.turn) for r in asked.collect()} == {(1, 2), (2, 0)}
    asked = asked.withColumn("project_id", F.when(F.col("query_id") == 1, "p").otherwise("big"))
    files = spark.createDataFrame(
        [("p", 2, "a"), ("p", 2, "b")] + [("big", 5000, f"f{i}") for i in range(5000)],
        "project_id string, n_files bigint, file_name string",
    )
    contexts = spark.createDataFrame([(1, "CTX")], "query_id bigint, context string")
    got = conversations.prompt_messages(asked, history, contexts, files, "Instr: ", limit=2)
    rows = got.orderBy("query_id", "section", "position").collect()
    blocks = [r for r in rows if r.query_id == 2 and r.content.startswith(FILES)]
    assert [r.position for r in blocks] == [1, 2, 3, 4, 5]
    named = [n for r in blocks for n in r.content.removeprefix(FILES).split(", ")]
    assert sorted(named) == sorted(f"f{i}" for i in range(5000))
    assert [(r.query_id, r.role, r.content.strip()) for r in rows if r not in blocks] == [
        (1, "system", "Instr: CTX"), (1, "system", FILES + "a, b"),
        (1, "assistant", "w w"), (1, "user", "w w w"),
        (2, "system", "Instr:"), (2, "user", "w"),
    ]


def test_project_files(spark):
    docs = spark.createDataFrame(
        [("p", "x/b.txt"), ("p", "x/a.txt"), ("p", "x/a.txt")], "project_id string, source string"
    )
    projects = spark.createDataFrame([("p",), ("q",)], "project_id string")
    got = conversations.project_files(docs, projects).orderBy("project_id", "file_name").collect()
    assert [tuple(r) for r in got] == [("p", 2, "a.txt"), ("p", 2, "b.txt"), ("q", 0, "Ninguno")]


def test_chunks_of_a_few_texts_at_once(spark, monkeypatch):
    """No batch that a task hands on grows with the number of texts Arrow hands it."""
    monkeypatch.setattr(chunking, "TEXTS_AT_ONCE", 3)
    rows = [(i, None if i % 7 == 1 else "" if i % 7 == 2 else f"word{i} " * (40 * i)) for i in range(50)]
    frame = spark.createDataFrame(rows, "doc_id int, text string").coalesce(1)
    got = chunking.chunk_recursive(frame, 100, 10)
    want = {(i, n, c) for i, t in rows if t for n, c in enumerate(split_text(t, 100, 10))}
    assert {tuple(r) for r in got.collect()} == want and got.columns == ["doc_id", "chunk_no", "text"]
    assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()
