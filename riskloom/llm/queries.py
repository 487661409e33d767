"""The queries of this subpackage over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import (
    chunk_recipes,
    collocations,
    decontamination,
    jaccard,
    licenses,
    lines,
    packing,
    personal_data,
    perspectives,
    prefix_trie,
    toxicity,
    url_rules,
    warc,
)

TOKENIZER = "word_bpe_49k.json"
URL_RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)


def bound_batches(spark: SparkSession, size: str = "8m") -> None:
    """Arrow batches end by bytes: ten thousand long texts would be much for a task to hold."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(setting) == "67108864b":
        spark.conf.set(setting, size)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.perspectives(table(spark, sf_dir, "conversations"))


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op3_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_recipes.exact_duplicates(table(spark, sf_dir, "documents"))


def op4_shared_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_shared_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op6_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.harmonic_packing(
        table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)
    )


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.personal_data(table(spark, sf_dir, "documents"))
    spans = F.col("personal")

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"].isin(*personal_data.BASE_KINDS))
    return found.select(
        "doc_id",
        *[count(kind) for kind in personal_data.BASE_KINDS],
        F.sha2(personal_data.listed(base), 256).alias("base_sha256"),
        personal_data.listed(spans).alias("spans"),
        F.concat_ws(",", F.transform(spans, lambda s: F.format_number(s["score"], 2))).alias("scores"),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(documents, table(spark, sf_dir, "labels"))
    return toxicity.score(documents, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids, sequences = prefix_trie.rebuilt(table(spark, sf_dir, "conversations"))
    trie = prefix_trie.prefix_trie(ids, sequences)
    ends = prefix_trie.list_digests(trie.end_lists)
    return trie.nodes.join(ends, prefix_trie.NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_perspectives, op2_jaccard, op3_chunk_recipes, op4_shared_lines, op5_licenses,
            op6_harmonic_packing, op7_personal_data, op8_decontamination, op9_url_rules,
            op10_toxicity, op11_prefix_trie, op12_collocations, op13_warc,
        )
    }
