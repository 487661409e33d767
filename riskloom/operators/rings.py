"""Rings: connected components with more than two members, their triage and their edges.

A component may hold a large share of all vertices, so its members are never gathered into one
row: at every size a ring is one summary row and one row per member.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.threat import (
    ThreatPolicy,
    contains_any,
    is_dangerous,
    level,
    node_type,
)
from riskloom.operators.graph import ADDRESS, COUNTRY, USER
from riskloom.operators.joins import MIN_HOT_ROWS, hot_split_join

def ring_sizes(members: DataFrame, larger_than: int = 2) -> DataFrame:
    return (
        members.groupBy("component")
        .agg(F.count(F.lit(1)).alias("num_entidades"))
        .filter(F.col("num_entidades") > larger_than)
    )


def ring_members(
    members: DataFrame, larger_than: int = 2, min_hot_rows: int = MIN_HOT_ROWS
) -> DataFrame:
    """The members of the rings, one per row, with the ring size."""
    sizes = ring_sizes(members, larger_than)
    known = sizes.withColumnRenamed("num_entidades", "n")
    return hot_split_join(
        members, sizes, ["component"], "inner", known, min_hot_rows=min_hot_rows
    ).select("component", "num_entidades", "tipo", "id")


def fraud_rings(ring_rows: DataFrame) -> DataFrame:
    """One row per ring with its size; the members are the rows of ``ring_rows``."""
    return ring_rows.groupBy("component").agg(F.first("num_entidades").alias("num_entidades"))


def ranked_rings(rings: DataFrame) -> DataFrame:
    return rings.orderBy(F.desc("num_entidades"), "component")


def ring_lookup(ring_rows: DataFrame, component: str) -> DataFrame:
    """The members of one ring."""
    return ring_rows.filter(F.col("component") == component)


def ring_severity(ring_rows: DataFrame, policy: ThreatPolicy = ThreatPolicy()) -> DataFrame:
    """Severity per ring from flags of its members; flags are combined before the shuffle."""
    name = F.upper(F.col("id"))
    return (
        ring_rows.groupBy("component", "num_entidades")
        .agg(
            F.max(contains_any(name, policy.critical_marks)).alias("critical"),
            F.max(contains_any(name, policy.elevated_marks)).alias("elevated"),
            F.max(name.isin(*policy.safe_members)).alias("safe"),
        )
        .select(
            "component",
            "num_entidades",
            level(F.col("critical"), F.col("elevated"), F.col("safe")).alias("nivel_amenaza"),
        )
    )


def triage(
    ring_rows: DataFrame,
    severity: DataFrame,
    show_safe: bool = False,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """The triage list, one row per ring and member, with its presentation names (fixed values).

    Quiet rings only on request.
    """
    levels = severity.select("component", "nivel_amenaza")
    if not show_safe:
        levels = levels.filter(is_dangerous(F.col("nivel_amenaza")))
    rows = hot_split_join(ring_rows, levels, ["component"], "inner", min_hot_rows=min_hot_rows)
    return rows.select(
        F.col("nivel_amenaza").alias("Severidad"),
        F.col("component").alias("ID Comunidad"),
        F.col("num_entidades").alias("Nº Nodos"),
        F.col("id").alias("Entidad Implicada"),
    )


def ring_topology(ring_rows: DataFrame) -> DataFrame:
    """Vertices per type and the number of lines the forensic drawing has.

    The drawing links every address with every user and every user with every country of a ring.
    These pairs follow from the member lists, so they are counted and not written out: their
    number is quadratic in the ring size.
    """
    kinds = ring_rows.groupBy("component").agg(
        F.count_if(F.col("tipo") == ADDRESS).alias("ips"),
        F.count_if(F.col("tipo") == USER).alias("usuarios"),
        F.count_if(F.col("tipo") == COUNTRY).alias("paises"),
    )
    return kinds.withColumn("lineas_ip_usuario", F.col("ips") * F.col("usuarios")).withColumn(
        "lineas_usuario_pais", F.col("usuarios") * F.col("paises")
    )


def ring_node_types(ring_rows: DataFrame) -> DataFrame:
    """Members with the type inferred from the form of the id, as needed for an exported list."""
    return ring_rows.select("component", "id", node_type(F.col("id")).alias("tipo_inferido"))


def ring_edges(
    ring_rows: DataFrame, edges: DataFrame, min_hot_rows: int = MIN_HOT_ROWS
) -> DataFrame:
    """The real edges inside the rings, parallel payments folded into a count.

    Edges that have an ``n`` (:func:`riskloom.operators.graph.folded_edges`) are folded already.
    """
    folded = edges
    if "n" not in edges.columns:
        folded = edges.groupBy("src_tipo", "src", "dst_tipo", "dst", "relacion").agg(
            F.count(F.lit(1)).alias("n")
        )
    ends = ring_rows.select(
        F.col("tipo").alias("src_tipo"), F.col("id").alias("src"), "component"
    )
    return hot_split_join(
        folded, ends, ["src_tipo", "src"], "inner", min_hot_rows=min_hot_rows
    ).select("component", "relacion", "src", "dst", "n")
