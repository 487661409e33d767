"""Exact stratified split without gathering a class in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.joins import lookup_join
from riskloom.session import ensure_checkpoint_dir

PREFIX = 4


def quotas(sizes: DataFrame, fraction: float) -> DataFrame:
    """Validation rows per class: ``ceil(fraction * rows)`` in all, by largest remainder.

    ``sizes`` has one row per class (``label``, ``n``), so its windows are small.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_remainder = Window.orderBy(F.desc("_rest"), "label")
    wanted = F.ceil(F.sum("n").over(everything) * F.lit(fraction))
    # Whole-number arithmetic, wide enough for the product of two counts.
    share = F.col("n").cast("decimal(19,0)") * F.col("_wanted").cast("decimal(19,0)")
    return (
        sizes.withColumn("_wanted", wanted)
        .withColumn("_all", F.sum("n").over(everything))
        .withColumn("_share", share)
        .withColumn("_rest", F.expr("_share % _all"))
        .withColumn("_floor", F.expr("_share div _all"))
        .withColumn("_missing", F.col("_wanted") - F.sum("_floor").over(everything))
        .withColumn("_extra", (F.row_number().over(by_remainder) <= F.col("_missing")).cast("int"))
        .select("label", (F.col("_floor") + F.col("_extra")).alias("quota"))
    )


def stratified_split(
    df: DataFrame, row_id: str, fraction: float = 0.2, seed: int = 42, prefix: int = PREFIX
) -> DataFrame:
    """Add ``split``: in each ``label`` the quota of rows with the smallest hashes is validation.

    Hash prefixes are counted per class; the running count shows the one prefix in which the cut
    falls. Only the rows of that prefix are ranked, everything else is decided row by row.
    """
    hashed = df.withColumn(
        "_hash", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(row_id).cast("string")))
    ).withColumn("_prefix", F.substring("_hash", 1, prefix))
    counts = hashed.groupBy("label", "_prefix").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy("label").agg(F.sum("n").alias("n"))
    so_far = (
        Window.partitionBy("label").orderBy("_prefix")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    cuts = (
        counts.withColumn("_upto", F.sum("n").over(so_far))
        .join(quotas(sizes, fraction), "label")
        .filter((F.col("_upto") >= F.col("quota")) & (F.col("_upto") - F.col("n") < F.col("quota")))
        .select(
            "label",
            F.col("_prefix").alias("_cut"),
            (F.col("quota") - F.col("_upto") + F.col("n")).alias("_take"),
        )
    )
    # One small row per class; written, so that its counting scan is not repeated below.
    ensure_checkpoint_dir(df.sparkSession)
    cuts = cuts.checkpoint()
    placed = lookup_join(hashed, cuts, ["label"])
    on_cut = F.col("_prefix") == F.col("_cut")
    before = F.col("_prefix") < F.col("_cut")
    decided = placed.filter(F.coalesce(~on_cut, F.lit(True))).withColumn(
        "split", F.when(before, "validation").otherwise("train")
    )
    by_hash = Window.partitionBy("label").orderBy("_hash", row_id)
    ranked = (
        placed.filter(on_cut)
        .withColumn("_rank", F.row_number().over(by_hash))
        .withColumn("split", F.when(F.col("_rank") <= F.col("_take"), "validation").otherwise("train"))
        .drop("_rank")
    )
    return decided.unionByName(ranked).select(*df.columns, "split")
