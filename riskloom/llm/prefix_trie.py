"""Conversations as a prefix trie, by collapsing whole sequences.

A prefix of d turns is known by its depth and 128 bits: the exclusive or of a hash of every turn with
its place, so all prefixes of a conversation come from one running aggregate, made in runs of a range
sort and hence without a task per conversation. Identical conversations become one weighted sequence
with the list of the conversations that end there; sequences that are proper prefixes of others are
dropped by an anti-join, which leaves the leaves; the weighted prefixes of the sequences, aggregated,
are the nodes.

Sums over a subtree need no walk. A node belongs to the path of its smallest member, and what a path
owns is its lower end. So the texts below a node, counted once per conversation, are the rests of its
members' paths; counted once per node, they are the rests that those paths own.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.folders import staged

PERIOD = 100
MOST_SHARED = 6
#: Conversation ids that are joined to one row of an end list.
LIST_BLOCK = 4096
NODE = ["depth", "high", "low"]
#: Run numbers of shared heads and of the root, before those of the range sort.
HEAD_RUN, ROOT_RUN = -1, -2


@dataclass
class Trie:
    """``nodes``; ``end_lists``, the conversations that end at a node in blocks of ascending ids;
    ``sequences``, every turn of every rebuilt conversation as conv_id, place, role and digest."""

    nodes: DataFrame
    end_lists: DataFrame
    sequences: DataFrame


def shared_turns(conv_id: Column, most_shared: int = MOST_SHARED) -> Column:
    """How many turns a conversation takes over from the first one of its block."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % most_shared).cast("long")


def digests(conversations: DataFrame) -> DataFrame:
    """Turns with the SHA-256 of the text in the text's place; rows without conv_id are left out."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.length(text).cast("long").alias("points"),
    )


def _earlier(column: str, function=F.sum) -> Column:
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(function(column).over(before), F.lit(0))


def rebuilt(
    conversations: DataFrame, period: int = PERIOD, most_shared: int = MOST_SHARED
) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: their ids, and their turns as conv_id, run, place, role, digest, points.

    Conversation c is the first h turns of conversation c - c % period (all if it has fewer), then its
    own turns after the first h, h being crc32(c) % most_shared. Turns are ordered by turn (null
    first), then role and digest of the text. ``run`` tells the parts of a conversation that lie in
    different tasks; none is longer than a task of the range sort.
    """
    order = ["conv_id", "turn", "role", "digest"]
    # Written once: a sort that runs again may choose other ranges.
    turns = staged(
        digests(conversations).repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("run", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()),
        "trie-turns",
    )
    runs = staged(
        turns.groupBy("conv_id", "run").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
        .withColumn("earlier", _earlier("n")),
        "trie-runs",
    )
    own_place = (F.col("at") - F.col("first") + F.col("earlier")).alias("own_place")
    turn = F.struct(own_place, "role", "digest", "points")
    heads = (
        turns.filter(F.col("conv_id") % period == 0).join(runs, ["conv_id", "run"])
        .filter(F.col("at") - F.col("first") + F.col("earlier") < most_shared - 1)
        .groupBy(F.col("conv_id").alias("source")).agg(F.array_sort(F.collect_list(turn)).alias("head"))
    )
    ids = staged(
        runs.select("conv_id").distinct()
        .withColumn("source", F.col("conv_id") - F.col("conv_id") % period)
        .withColumn("shared", shared_turns(F.col("conv_id"), most_shared))
        .join(heads, "source", "left")
        .withColumn("head", F.when(F.col("shared") > 0, F.slice("head", 1, F.col("shared").cast("int"))))
        .withColumn("n_head", F.greatest(F.size("head"), F.lit(0)).cast("long"))
        .select("conv_id", "shared", "n_head", "head"),
        "trie-conversations",
    )
    taken = ids.filter("n_head > 0").select("conv_id", F.posexplode("head").alias("place", "turn")).select(
        "conv_id", F.lit(HEAD_RUN).alias("run"), F.col("place").cast("long").alias("place"),
        "turn.role", "turn.digest", "turn.points",
    )
    placed = runs.select("conv_id", "run", "first", "earlier").join(ids.drop("head"), "conv_id")
    own = (
        turns.join(placed, ["conv_id", "run"])
        .withColumn("own_place", own_place)
        .filter("own_place >= shared")
        .select(
            "conv_id", "run", (F.col("own_place") - F.col("shared") + F.col("n_head")).alias("place"),
            "role", "digest", "points",
        )
    )
    return ids.select("conv_id"), taken.unionByName(own)


def _hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "place", "role", "digest")


def prefix_trie(ids: DataFrame, sequences: DataFrame) -> Trie:
    """The trie of conversations given as their ``ids`` (conv_id, unique) and turns (see :func:`rebuilt`).

    Nodes have conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs,
    n_children, n_leaves (childless nodes below or at it) and saved_tokens: over its subtree, the
    code points of each node's last text once for every member but one. The root stands for no
    turns; an id without turns is a member of it only. Without ids there are no nodes.
    """
    along = Window.partitionBy("conv_id", "run").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    turns = staged(
        sequences.withColumns({"h": _hash(1), "l": _hash(2)}).withColumns({
            "high": F.bit_xor("h").over(along),
            "low": F.bit_xor("l").over(along),
            "until": F.sum("points").over(along),
        }),
        "trie-sequences",
    )
    runs = staged(
        turns.groupBy("conv_id", "run").agg(
            F.bit_xor("h").alias("h"), F.bit_xor("l").alias("l"),
            F.sum("points").alias("points"), F.count(F.lit(1)).alias("n"),
        ).withColumns({
            "h_before": _earlier("h", F.bit_xor),
            "l_before": _earlier("l", F.bit_xor),
            "points_before": _earlier("points"),
        }),
        "trie-sums",
    )
    whole = runs.groupBy("conv_id").agg(
        F.sum("n").alias("depth"), F.bit_xor("h").alias("high"), F.bit_xor("l").alias("low"),
        F.sum("points").alias("total"),
    )
    ends = staged(ids.join(whole, "conv_id", "left").na.fill(0, [*NODE, "total"]), "trie-ends")

    # Identical conversations are one sequence, called by its smallest id.
    weighted = staged(
        ends.groupBy(*NODE).agg(
            F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"), F.min("total").alias("total")
        ),
        "trie-weighted",
    )
    long_runs = runs.select("conv_id", "run", "h_before", "l_before", "points_before").join(
        weighted.select("conv_id", "weight", "total"), "conv_id"
    )
    before = F.col("points_before") + F.col("until") - F.col("points")
    high, low = F.col("high").bitwiseXOR(F.col("h_before")), F.col("low").bitwiseXOR(F.col("l_before"))
    paths = turns.join(long_runs, ["conv_id", "run"]).select(
        "conv_id", "run", (F.col("place") + 1).alias("depth"), high.alias("high"), low.alias("low"),
        high.bitwiseXOR(F.col("h")).alias("up_high"), low.bitwiseXOR(F.col("l")).alias("up_low"),
        before.alias("before"), "weight", "total",
    )
    zero = F.lit(0).cast("long")
    roots = weighted.select(
        "conv_id", F.lit(ROOT_RUN).alias("run"),
        *[zero.alias(c) for c in ("depth", "high", "low", "up_high", "up_low", "before")], "weight", "total",
    )
    prefixes = staged(paths.unionByName(roots), "trie-prefixes")
    nodes = staged(
        prefixes.groupBy(*NODE).agg(
            F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"),
            F.sum(F.col("weight") * (F.col("total") - F.col("before"))).alias("each_time"),
            F.min("up_high").alias("up_high"), F.min("up_low").alias("up_low"), F.min("before").alias("before"),
        ),
        "trie-nodes",
    )
    up = [(F.col("depth") - 1).alias("depth"), F.col("up_high").alias("high"), F.col("up_low").alias("low")]
    inner = nodes.filter("depth > 0").groupBy(*up).agg(F.count(F.lit(1)).alias("n_children"))
    leaves = weighted.join(inner, NODE, "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    owned = nodes.groupBy("conv_id").agg(F.min("before").alias("owned_from"))
    named = weighted.select("conv_id").join(owned, "conv_id", "left").join(leaves, "conv_id", "left")
    keys = runs.select("conv_id", "run").unionByName(weighted.select("conv_id", F.lit(ROOT_RUN).alias("run")))
    marks = keys.join(named, "conv_id")
    rest = F.col("total") - F.greatest("before", "owned_from")
    below = prefixes.join(marks, ["conv_id", "run"]).groupBy(*NODE).agg(
        F.coalesce(F.sum("leaf"), F.lit(0)).alias("n_leaves"),
        F.coalesce(F.sum(F.when(F.col("owned_from").isNotNull(), rest)), F.lit(0)).alias("once"),
    )
    parents = nodes.select(
        F.col("depth").alias("_depth"), F.col("high").alias("_high"), F.col("low").alias("_low"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    found = (
        nodes.join(
            parents,
            (F.col("depth") - 1 == F.col("_depth")) & (F.col("up_high") == F.col("_high")) & (F.col("up_low") == F.col("_low")),
            "left",
        )
        .join(below, NODE, "left")
        .join(inner, NODE, "left")
        .select(
            *NODE, "conv_id", "parent_conv_id", "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves",
            (F.col("each_time") - F.col("once")).alias("saved_tokens"),
        )
    )
    return Trie(found, _end_lists(ends), turns.select("conv_id", "place", "role", "digest"))


def _end_lists(ends: DataFrame) -> DataFrame:
    """Node, block and at most ``LIST_BLOCK`` ascending ids; later blocks have greater ids."""
    order = [*NODE, "conv_id"]
    sorted_ends = staged(
        ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("block", F.floor(F.monotonically_increasing_id() / LIST_BLOCK)),
        "trie-end-lists",
    )
    return sorted_ends.groupBy(*NODE, "block").agg(F.array_sort(F.collect_list("conv_id")).alias("conv_ids"))


def list_digests(end_lists: DataFrame) -> DataFrame:
    """Per node with ends the SHA-256 of its ids, comma-joined; blocks are hashed as they stream by."""

    def run(batches):
        node, digest = None, None
        for batch in batches:
            keys, found = zip(*(batch.column(i).to_pylist() for i in range(3))), []
            for key, joined in zip(keys, batch.column(3).to_pylist()):
                if key != node:
                    if node is not None:
                        found.append((*node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256(joined.encode())
                else:
                    digest.update(b"," + joined.encode())
            yield _digest_rows(found)
        if node is not None:
            yield _digest_rows([(*node, digest.hexdigest())])

    joined = F.concat_ws(",", F.transform("conv_ids", lambda i: i.cast("string")))
    return (
        end_lists.select(*NODE, "block", joined.alias("joined"))
        .repartition(*NODE)
        .sortWithinPartitions(*NODE, "block")
        .select(*NODE, "joined")
        .mapInArrow(run, "depth long, high long, low long, ends_sha256 string")
    )


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    columns = zip(*rows) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*NODE, "ends_sha256"])


def with_last_turns(trie: Trie, conversations: DataFrame) -> DataFrame:
    """Nodes with the role and text of their last turn, null at the root."""
    turns = trie.sequences.withColumn("depth", F.col("place") + 1).drop("place")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # Equal texts are one row; the digest stands for the text.
    known = conversations.select(F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text")).dropDuplicates(["digest"])
    return trie.nodes.join(turns, ["conv_id", "depth"], "left").join(known, "digest", "left").drop("digest")
