"""Chat formatting: every participant's view of a dialogue.

In the view of a participant its own messages are the assistant's, those of the others are named
users', and only its own messages are trained on. A dialogue of any length is rendered in segments
of a fixed number of messages, so a conversation with very many messages is the work of many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.folders import staged

SEGMENT_MESSAGES = 256
SYSTEM = "system"
#: Marks of the rendered text; in a message's own text the marks are broken up.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
BROKEN = "<\\|"


def numbered(turns: DataFrame) -> DataFrame:
    """Add ``place``, the number of a message in its conversation, counted without one task per
    conversation: messages are sorted by range, each run of a conversation in a partition is
    counted, and the runs before it are added."""
    order = ["conv_id", "turn", "role", "text"]
    # Written once: a sort that runs again may choose other ranges.
    runs = staged(
        turns.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id()),
        "perspective-turns",
    )
    counts = runs.groupBy("conv_id", "part").agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("n")
    )
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).select(
        F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), "first", "before"
    )
    return (
        runs.join(bases, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")))
        .withColumn("place", F.col("at") - F.col("first") + F.col("before"))
        .select("conv_id", "turn", "role", "text", "place")
    )


def perspectives(conversations: DataFrame, segment: int = SEGMENT_MESSAGES) -> DataFrame:
    """One row per conversation, participant and segment of at most ``segment`` messages.

    ``conversations`` has conv_id, turn, role and text. Messages stand in the order of turn, role
    and text. Participants are the roles but "system", whose messages keep their role in every
    view; a conversation without participants has no row. ``text`` is the rendered segment,
    ``mask`` the spans to train on as start:end in code points, comma-joined: the viewer's texts
    with their closing mark. ``first_place`` counts the messages before the segment.

    A null role is the participant named "", a null text is empty, a null conv_id is a conversation
    of its own, null turns come first. Repeated rows are repeated messages. Other columns are
    ignored.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    placed = numbered(turns).withColumn("segment", F.floor(F.col("place") / segment))
    message = F.struct(
        "place", "role", F.replace("text", F.lit("<|"), F.lit(BROKEN)).alias("text")
    )
    # At most ``segment`` messages are gathered.
    segments = placed.groupBy("conv_id", "segment").agg(F.array_sort(F.collect_list(message)).alias("messages"))
    viewers = (
        turns.filter(F.col("role") != SYSTEM)
        .select(F.col("conv_id").alias("_conv"), F.col("role").alias("perspective"))
        .distinct()
    )
    views = segments.join(viewers, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")

    def head(m):
        return (
            F.when(m["role"] == F.col("perspective"), F.lit(f"{OPEN}assistant\n"))
            .when(m["role"] == SYSTEM, F.lit(f"{OPEN}system\n"))
            .otherwise(F.concat(F.lit(f"{OPEN}user name="), m["role"], F.lit("\n")))
        )

    rendered = views.withColumn(
        "parts",
        F.transform(
            "messages",
            lambda m: F.struct(
                head(m).alias("head"),
                m["text"].alias("text"),
                (m["role"] == F.col("perspective")).alias("own"),
            ),
        ),
    )
    end = F.lit(f"{CLOSE}\n")
    spans = F.aggregate(
        "parts",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans")),
        lambda done, p: F.struct(
            (done["at"] + F.length(p["head"]) + F.length(p["text"]) + len(CLOSE) + 1).alias("at"),
            F.when(
                p["own"],
                F.concat(
                    done["spans"],
                    F.array(
                        F.concat_ws(
                            ":",
                            (done["at"] + F.length(p["head"])).cast("string"),
                            (done["at"] + F.length(p["head"]) + F.length(p["text"]) + len(CLOSE)).cast("string"),
                        )
                    ),
                ),
            ).otherwise(done["spans"]).alias("spans"),
        ),
        lambda done: F.concat_ws(",", done["spans"]),
    )
    return rendered.select(
        "conv_id",
        "perspective",
        "segment",
        F.col("messages")[0]["place"].alias("first_place"),
        F.size("messages").cast("long").alias("n_messages"),
        F.size(F.filter("parts", lambda p: p["own"])).cast("long").alias("n_own"),
        F.concat_ws("", F.transform("parts", lambda p: F.concat(p["head"], p["text"], end))).alias("text"),
        spans.alias("mask"),
    )
