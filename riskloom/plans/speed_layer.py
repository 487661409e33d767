"""Launcher of the streaming layer on Kafka topics."""

from __future__ import annotations

from pyspark.sql import SparkSession

from riskloom import schemas
from riskloom.functions.risk import RiskPolicy
from riskloom.sources.files import read_blacklist
from riskloom.streaming.queries import start_all
from riskloom.streaming.sources import PAYMENT_TOPIC, VISIT_TOPIC, kafka_events


def run(
    spark: SparkSession,
    servers: str,
    root: str,
    blacklist_path: str,
    policy: RiskPolicy = RiskPolicy(),
    max_offsets: int | None = None,
) -> None:
    """Start the three queries and wait until one of them ends.

    The blacklist is read once; a new file counts from the next start on.
    """
    payments = kafka_events(spark, servers, PAYMENT_TOPIC, schemas.PAYMENT, max_offsets=max_offsets)
    visits = kafka_events(spark, servers, VISIT_TOPIC, schemas.VISIT, max_offsets=max_offsets)
    start_all(payments, visits, read_blacklist(spark, blacklist_path), root, policy)
    spark.streams.awaitAnyTermination()
