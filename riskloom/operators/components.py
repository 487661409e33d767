"""Connected components by alternating large-star and small-star steps.

Method: Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). A step replaces
every edge by one to the smallest neighbour; the edge count never grows and the graph becomes a
set of stars, whose centres are the components, after O(log^2 n) rounds. Every second round is
written to the checkpoint folder (every step, once the graph is large), so neither lineage nor a
lost executor makes the work before it run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.graph import vertex_key
from riskloom.operators.joins import MIN_HOT_ROWS, fits_broadcast, hot_keys, hot_split_join
from riskloom.session import ensure_checkpoint_dir

ROUNDS = 2


def _with_smallest(links: DataFrame, n_links: int, min_hot_rows: int) -> DataFrame:
    """Add to each (u, v) the smallest v of its u, called m.

    One shuffle by u serves the ordinary vertices. Hubs stay out of it: their few minima are
    aggregated on the map side and broadcast.
    """
    cold, hubs = links, None
    if n_links > min_hot_rows:
        counts = links.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        hubs = hot_keys(counts, ["u"], n_links, min_hot_rows)
    if hubs is not None:
        cold = links.join(hubs, "u", "left_anti")
    by_vertex = F.min("v").over(Window.partitionBy("u"))
    marked = cold.withColumn("m", by_vertex)
    if hubs is None:
        return marked
    at_hubs = links.join(hubs, "u", "left_semi")
    minima = at_hubs.groupBy("u").agg(F.min("v").alias("m"))
    return marked.unionByName(at_hubs.join(F.broadcast(minima), "u").select("u", "v", "m"))


def _large_star(edges: DataFrame, n_edges: int, min_hot_rows: int) -> DataFrame:
    """Hang the larger neighbours of each vertex on its smallest neighbour (or on itself).

    Copies may arise; they stay within the edge count and go in the next small-star step.
    """
    both = edges.select(
        F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))))
        .alias("e")
    ).select("e.*")
    return (
        _with_smallest(both, 2 * n_edges, min_hot_rows)
        .filter("v > u")
        .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
    )


def _small_star(edges: DataFrame, n_edges: int, min_hot_rows: int) -> DataFrame:
    """Hang each vertex and its smaller neighbours on the smallest of them."""
    pairs = F.array(
        F.struct(F.col("u"), F.col("m").alias("v")),
        F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
    )
    return (
        _with_smallest(edges, n_edges, min_hot_rows)
        .select(F.explode(pairs).alias("e"))
        .select("e.*")
        .filter("u > v")
        .distinct()
    )


def _shape(edges: DataFrame) -> tuple[int, bool]:
    """The edge count, and whether the edges are stars.

    They are when every vertex hangs on one centre only and no centre hangs on another. One
    aggregation over the edge ends tells both.
    """
    ends = F.explode(
        F.array(
            F.struct(F.col("u").alias("id"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")),
            F.struct(F.col("v").alias("id"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")),
        )
    ).alias("end")
    hangs, holds = F.col("hangs"), F.col("holds")
    row = (
        edges.select(ends)
        .groupBy("end.id")
        .agg(F.sum("end.hangs").alias("hangs"), F.max("end.holds").alias("holds"))
        .agg(
            F.coalesce(F.sum(hangs), F.lit(0)).alias("n"),
            F.count_if((hangs > 1) | ((hangs > 0) & (holds > 0))).alias("tangled"),
        )
        .first()
    )
    return row["n"], row["tangled"] == 0


def star_labels(
    edges: DataFrame, min_hot_rows: int = MIN_HOT_ROWS, rounds: int = ROUNDS
) -> DataFrame:
    """(u, v) with numeric ids to (u, root): every vertex but the roots, with its smallest member.

    ``rounds`` pairs of steps run before their result is written and looked at.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    current = (
        edges.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .checkpoint()
    )
    n_edges, done = _shape(current)
    while not done:
        for _ in range(rounds):
            current = _large_star(current, n_edges, min_hot_rows)
            if n_edges > min_hot_rows:
                # The next step reads it several times to find and treat the hubs.
                current = current.checkpoint()
            current = _small_star(current, n_edges, min_hot_rows)
            if n_edges > min_hot_rows:
                current = current.checkpoint()
        if n_edges <= min_hot_rows:
            current = current.checkpoint()
        n_edges, done = _shape(current)
    return current.select("u", F.col("v").alias("root"))


def connected_components(
    vertices: DataFrame,
    edges: DataFrame,
    min_hot_rows: int = MIN_HOT_ROWS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Add ``component`` to the vertices: the smallest ``type:id`` among the members.

    Vertices without edges are their own component. The result is written to the checkpoint
    folder, because reports read it several times.
    """
    ensure_checkpoint_dir(vertices.sparkSession)
    # Numbers follow the sort order of the keys, so the smallest number is the smallest key.
    numbered = (
        vertices.select(vertex_key(F.col("tipo"), F.col("id")).alias("key"), "tipo", "id")
        .orderBy("key")
        .withColumn("n", F.monotonically_increasing_id())
        .checkpoint()
    )
    names = numbered.select("key", "n")
    pairs = (
        edges.select(
            vertex_key(F.col("src_tipo"), F.col("src")).alias("a"),
            vertex_key(F.col("dst_tipo"), F.col("dst")).alias("b"),
        )
        .distinct()
        .checkpoint()
    )
    names_fit = fits_broadcast(names)

    def named(fact: DataFrame, lookup: DataFrame, key: str, counted: DataFrame) -> DataFrame:
        if names_fit:
            return fact.join(F.broadcast(lookup), key)
        counts = counted.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        return hot_split_join(fact, lookup, [key], "inner", counts, min_hot_rows=min_hot_rows)

    left = names.select(F.col("key").alias("a"), F.col("n").alias("u"))
    right = names.select(F.col("key").alias("b"), F.col("n").alias("v"))
    linked = named(named(pairs, left, "a", pairs), right, "b", pairs)
    stars = star_labels(linked.select("u", "v"), min_hot_rows, rounds)

    rooted = numbered.join(stars.withColumnRenamed("u", "n"), "n", "left").select(
        "tipo", "id", F.coalesce("root", "n").alias("root")
    )
    roots = names.select(F.col("n").alias("root"), F.col("key").alias("component"))
    labelled = named(rooted, roots, "root", rooted)
    return labelled.select("component", "tipo", "id").checkpoint()
