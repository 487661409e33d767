"""Use of all cores for tables that come in a few files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """Spread the rows over the cores if the table has fewer files than there are cores.

    A file with one row group is read by one task, and whatever follows in the same stage runs
    there too. Tables of many files are left as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df
