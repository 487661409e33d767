"""Stream sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskloom.sources.files import decode_json

# Topic names.
PAYMENT_TOPIC = "datos_pagos"
VISIT_TOPIC = "datos_visitas"


def kafka_options(
    servers: str,
    topic: str,
    starting: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets: int | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_events(
    spark: SparkSession, servers: str, topic: str, schema: T.StructType, **options
) -> DataFrame:
    """Decoded events of a topic with their ``event_time``; needs the Kafka connector package at submit time."""
    raw = spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options))
    return decode_json(raw.load().withColumnRenamed("timestamp", "event_time"), schema, keep=("event_time",))


def file_events(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "parquet",
    name_filter: str | None = None,
    max_files: int | None = None,
    clean_source: str | None = None,
    archive_dir: str | None = None,
) -> DataFrame:
    """Files of a landing folder, each read once.

    ``clean_source`` is ``archive`` or ``delete``: sources are removed only after the batch that
    read them is committed, and a file that cannot be removed does not stop the stream.
    """
    reader = spark.readStream.format(file_format).schema(schema)
    for key, value in {
        "pathGlobFilter": name_filter,
        "maxFilesPerTrigger": max_files,
        "cleanSource": clean_source,
        "sourceArchiveDir": archive_dir,
    }.items():
        if value is not None:
            reader = reader.option(key, value)
    return reader.load(path)
