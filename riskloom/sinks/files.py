"""Warehouse tables, CSV exports and removal of data that is no longer wanted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def overwrite_table(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").saveAsTable(table)


def append_partition(df: DataFrame, path: str, partition: str, gather: bool = True) -> None:
    """Write the partitions present in ``df``; running it again replaces them.

    ``gather`` rebalances first: each partition value goes into few files and a large one is split
    over tasks. It costs a shuffle, so switch it off where all rows belong to one partition.
    """
    rows = df.hint("rebalance", partition) if gather else df
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header, written by the executors; the files of a sorted table follow its order."""
    df.write.mode("overwrite").option("header", True).csv(path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder on any file system Spark knows; tells whether there was one."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(target) and files.delete(target, True)


def purge_project(spark: SparkSession, path: str, project_id: str) -> bool:
    """Drop one project from a table partitioned by ``project_id``."""
    return delete_path(spark, f"{path}/project_id={project_id}")
