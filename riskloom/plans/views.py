"""The engine's inputs as views over the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.risk import RiskPolicy
from riskloom.functions.text import join_path
from riskloom.functions.threat import ThreatPolicy
from riskloom.operators.balance import spread
from riskloom.operators.conversations import last_questions
from riskloom.operators.joins import lookup_join

POLICY = RiskPolicy(
    amount_above=400000.0, sanctioned=("NATION_3", "NATION_7"), risky_methods=("1-URGENT",)
)
THREATS = ThreatPolicy(
    critical_marks=("10.0.7.", "10.0.11."),
    elevated_marks=("10.0.2",),
    safe_members=tuple(f"NATION_{i}" for i in range(20)),
)


# Declared, so that opening a table starts no job.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def as_payments(orders: DataFrame, customers: DataFrame, nations: DataFrame) -> DataFrame:
    """Orders as payments; a stream of orders works as well."""
    countries = nations.select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("card_country")
    )
    # The nation table has 25 rows at every scale.
    payers = customers.join(F.broadcast(countries), "c_nationkey").select(
        F.col("c_custkey").alias("o_custkey"), "card_country"
    )
    return lookup_join(orders, payers, ["o_custkey"], "inner").select(
        F.col("o_orderkey").cast("string").alias("tx_id"),
        F.concat(F.lit("U"), F.col("o_custkey").cast("string")).alias("user_id"),
        F.col("o_totalprice").alias("amount"),
        F.lit("EUR").alias("currency"),
        "card_country",
        F.col("o_orderpriority").alias("method"),
        (F.col("o_orderstatus") == "P").alias("flag_ataque"),
    )


def payments(spark: SparkSession, folder: str) -> DataFrame:
    return as_payments(
        table(spark, folder, "orders"),
        table(spark, folder, "customer"),
        table(spark, folder, "nation"),
    )


def as_visits(events: DataFrame) -> DataFrame:
    """Events as visits.

    Four users share a subnet; a visitor who buys for more than 200 is a known customer.
    """
    block = F.floor(F.col("user_id") / 4)
    known = (F.col("event_type") == "purchase") & (F.col("value") > 200)
    return events.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.concat(F.when(known, "U").otherwise("V"), F.col("user_id").cast("string")).alias("user_id"),
        F.concat_ws(
            ".",
            F.lit("10"),
            F.floor(block / 256).cast("string"),
            F.pmod(block, F.lit(256)).cast("string"),
            F.get_json_object("props", "$.k"),
        ).alias("ip"),
        F.pmod("event_id", F.lit(600)).cast("int").alias("session_duration"),
        F.floor("value").cast("int").alias("pages_visited"),
        (F.col("event_type") == "error").alias("is_bot"),
        (F.col("event_type") == "purchase").alias("flag_ataque"),
    )


def visits(spark: SparkSession, folder: str) -> DataFrame:
    return as_visits(table(spark, folder, "events"))


def blacklist(spark: SparkSession, folder: str) -> DataFrame:
    """Addresses that once read more than 200 pages in a visit."""
    peaks = visits(spark, folder).groupBy("ip").agg(F.max("pages_visited").alias("peak"))
    label = F.when(F.col("peak") > 300, "CRITICO_BOTNET").otherwise("SOSPECHOSO")
    return peaks.filter(F.col("peak") > 200).select("ip", label.alias("riesgo_historico"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of one source are the pages of one file of the project (the language)."""
    extension = (
        F.when(F.col("source") == "src5", ".md")
        .when(F.length("source") > 4, ".pdf")
        .otherwise(".txt")
    )
    path = join_path(
        F.lit("data/projects"), F.col("lang"), F.lit("docs"), F.concat("source", extension)
    )
    return spread(table(spark, folder, "documents")).select(
        "doc_id",
        F.col("lang").alias("project_id"),
        path.alias("source"),
        F.when(extension == ".pdf", F.col("doc_id")).alias("page"),
        "text",
    )


def passages(spark: SparkSession, folder: str) -> DataFrame:
    """The corpus of the vector queries: the documents that have a row in ``embeddings``.

    That table alone is the corpus, as in the queries' SQL: a document without a stored vector is
    never searched, and no other encoder's vectors can be compared with the stored ones.
    ``corpus_search`` encodes the texts itself and needs no stored vector.
    """
    vectors = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector")
    )
    return documents(spark, folder).join(vectors, "doc_id").withColumnRenamed("doc_id", "chunk_id")


def asked(spark: SparkSession, folder: str) -> DataFrame:
    """The last user turn of each conversation, with the project of the same number."""
    projects = documents(spark, folder).select(
        F.col("doc_id").alias("conv_id"), "project_id", F.col("source").alias("own_source")
    )
    return (
        last_questions(table(spark, folder, "conversations"))
        .join(projects, "conv_id")
        .withColumnRenamed("conv_id", "query_id")
        .withColumn("source_filter", F.lit(None).cast("string"))
    )


def questions(spark: SparkSession, folder: str) -> DataFrame:
    """The questions :func:`asked` that have a vector.

    Their vector is the stored one of that number in reverse, which lies near no passage by design.
    """
    vectors = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("query_id"), F.reverse("embedding").alias("vector")
    )
    return asked(spark, folder).join(vectors, "query_id")


def rasters(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors as 8 x 8 pictures of one channel with values 0 to 255."""
    return spread(table(spark, folder, "embeddings")).select(
        F.col("vec_id").alias("id"),
        F.transform(
            "embedding", lambda v: F.round((v.cast("double") + 1) * 127.5).cast("int")
        ).alias("pixels"),
        F.array("label").alias("label"),
    )


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), "label", F.col("embedding").alias("vector")
    )


def rule_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Three rule models for the quality label, with class probabilities."""
    facts = lookup_join(
        table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label")),
        table(spark, folder, "documents").select("doc_id", "n_chars"),
        ["doc_id"],
        "inner",
    )
    length = F.col("n_chars").cast("double")
    bounded = [
        ("long text", F.least(F.lit(0.95), F.greatest(F.lit(0.05), length / 2000))),
        ("short text", F.least(F.lit(0.95), F.greatest(F.lit(0.05), 1 - length / 4000))),
        ("always good", F.lit(1.0)),
    ]
    models = F.array(
        *[F.struct(F.lit(name).alias("model"), p.alias("p")) for name, p in bounded]
    )
    return (
        facts.withColumn("m", F.explode(models))
        .select(
            F.col("m.model").alias("model"),
            F.col("doc_id").alias("id"),
            "label",
            F.array(1 - F.col("m.p"), F.col("m.p")).alias("probabilities"),
        )
    )
