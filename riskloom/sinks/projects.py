"""Projects and their chat turns, stored with one folder per project."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.text import formatted_now
from riskloom.operators.keyed import latest_by_key
from riskloom.sinks.files import purge_project

TURNS = "conv_id bigint, turn bigint, role string, text string, project_id string"


def register_projects(names: DataFrame, path: str) -> None:
    """Append a project row (new id, name, time of creation) for every ``name``."""
    names.select(F.uuid().alias("id"), "name", formatted_now().alias("created_at")).write.mode(
        "append"
    ).parquet(path)


def append_turns(turns: DataFrame, path: str) -> None:
    turns.hint("rebalance", "project_id").write.mode("append").partitionBy("project_id").parquet(
        path
    )


def read_turns(spark: SparkSession, path: str) -> DataFrame:
    """Stored turns; one that was written twice counts once."""
    rows = spark.read.schema(TURNS).parquet(path)
    return latest_by_key(rows, ["project_id", "conv_id", "turn"], [])


def clear_history(spark: SparkSession, path: str, project_id: str) -> bool:
    """Forget the turns of one project; tells whether there were any."""
    return purge_project(spark, path, project_id)
