"""From raw documents to packed training sequences, stage by stage.

Each stage reads all that its predecessor kept, written as Parquet in between. Rows are dropped by id
and text, so that a null or repeated id neither saves a row nor loses another one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import chunk_recipes, decontamination, jaccard, packing, toxicity
from riskloom.llm.chunk_recipes import NULL_ID
from riskloom.llm.folders import staged
from riskloom.llm.queries import TOKENIZER, table
from riskloom.operators.joins import lookup_join

#: SQL can express neither the classifier nor the tokens.
ORACLE_SQL = None


#: Columns added while a stage runs: the id with a number for null, the digest of the text, the score.
ID, DIGEST, TOXICITY = "_pipeline_id", "_pipeline_digest", "_pipeline_toxicity"


def _number(name: str = "doc_id"):
    return F.coalesce(F.col(name).cast("long"), F.lit(NULL_ID))


def _digest():
    return F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256)


def _without(docs: DataFrame, dropped: DataFrame, on: list[str]) -> DataFrame:
    """The documents whose key, which is never null, is not among ``dropped``."""
    return lookup_join(docs, staged(dropped.distinct(), "pipeline-dropped"), on, "left_anti")


def _keyed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``docs`` with a doc_id for each pair of id and text, the old one as ID, and whether some id is
    new.

    An id that is null or stands for several rows is replaced by a hash of it and the text. Rows of
    one id and one text stay under one doc_id.
    """
    held = docs.withColumn(ID, _number())
    unclear = staged(
        held.groupBy(ID).agg(F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) | (F.col(ID) == NULL_ID)).select(ID, F.lit(True).alias("_unclear")),
        "pipeline-unclear",
    )
    if unclear.isEmpty():
        return held.withColumn(DIGEST, F.lit("")), False
    held = staged(
        lookup_join(held, unclear, [ID]).withColumn(DIGEST, F.when(F.col("_unclear"), _digest()).otherwise("")),
        "pipeline-marked",
    )
    for salt in range(100):
        own = F.when(F.col("_unclear"), F.xxhash64(F.lit(salt), ID, DIGEST)).otherwise(F.col(ID))
        keys = held.select(ID, DIGEST, own.alias("own")).distinct()
        # As a rule no two hashes meet, nor does one meet an id.
        if keys.groupBy("own").count().filter((F.col("count") > 1) | (F.col("own") == NULL_ID)).isEmpty():
            return held.withColumn("doc_id", own).drop("_unclear"), True
    raise ValueError("no hash tells the documents apart")


def _restored(keyed: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows of :func:`_keyed` with the ids and columns of ``docs``."""
    kind = docs.schema["doc_id"].dataType
    old = F.when(F.col(ID) != NULL_ID, F.col(ID)).cast(kind)
    return keyed.withColumn("doc_id", old).select(*docs.columns)


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic; it learns from the labelled ones."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, TOXICITY).filter(F.col(TOXICITY) < 0.5).drop(TOXICITY)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row, with the largest id; null is below all ids, a null text is empty."""
    found = staged(
        chunk_recipes.exact_duplicates(docs)
        .select(_number().alias(ID), F.col("text_sha256").alias(DIGEST), "kept", "group_size"),
        "pipeline-copies",
    )
    grouped = found.filter("group_size > 1")
    if grouped.isEmpty():
        return docs
    held = _without(
        docs.withColumns({ID: _number(), DIGEST: _digest()}), grouped.filter("NOT kept").select(ID, DIGEST), [ID, DIGEST]
    )
    repeated = staged(
        grouped.filter("kept").groupBy(ID, DIGEST).agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1").select(ID, DIGEST),
        "pipeline-repeated",
    )
    if not repeated.isEmpty():
        once = lookup_join(held, repeated, [ID, DIGEST], "left_semi").dropDuplicates([ID, DIGEST])
        held = _without(held, repeated, [ID, DIGEST]).unionByName(once)
    return held.select(*docs.columns)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; null is below all ids."""
    keyed, new = _keyed(docs)
    groups = jaccard.jaccard_components(keyed)
    if new:
        # The component is named by a new id; what stays is the smallest old one.
        named = keyed.select("doc_id", ID, DIGEST).distinct()
        groups = staged(groups.select("doc_id", "component_id").distinct().join(named, "doc_id"), "pipeline-groups")
        first = groups.groupBy("component_id").agg(F.min(F.struct(ID, DIGEST, "doc_id"))["doc_id"].alias("first"))
        groups = groups.join(first, "component_id").select("doc_id", F.col("first").alias("component_id"))
    dropped = groups.filter("doc_id <> component_id").select("doc_id")
    return _restored(_without(keyed, dropped, ["doc_id"]), docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    keyed, _ = _keyed(docs)
    hits = decontamination.contamination(keyed, table(spark, sf_dir, "benchmark"))
    return _restored(_without(keyed, hits.filter("n_hit > 0").select("doc_id"), ["doc_id"]), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that stay, packed into sequences."""
    return packing.harmonic_packing(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", keep_civil),
    ("exact_dedup", keep_one_copy),
    ("ngram_jaccard", keep_one_of_similar),
    ("decontamination", keep_uncontaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
