"""Graph of users, countries and addresses: vertices, edges, degrees and hubs.

A vertex is identified by type and id together, so equal ids of different types stay apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import ensure_checkpoint_dir

# Vertex types and edge relations.
USER = "usuario"
COUNTRY = "pais"
ADDRESS = "ip"
PAYMENT_EDGE = "pago"
VISIT_EDGE = "visita"
ALL = "TODOS"


def vertex_key(tipo: Column, node: Column) -> Column:
    return F.concat(tipo, F.lit(":"), node)


def _nodes(df: DataFrame, column: str, tipo: str) -> DataFrame:
    return df.select(F.col(column).alias("id"), F.lit(tipo).alias("tipo")).filter(
        F.col("id").isNotNull()
    )


def vertices(payments: DataFrame, visits: DataFrame) -> DataFrame:
    """Distinct users of payments and visits, countries and addresses."""
    users = _nodes(payments, "user_id", USER).union(_nodes(visits, "user_id", USER))
    return (
        users.unionByName(_nodes(payments, "card_country", COUNTRY))
        .unionByName(_nodes(visits, "ip", ADDRESS))
        .distinct()
    )


def payment_edges(payments: DataFrame) -> DataFrame:
    """User to country, one edge per payment."""
    return payments.select(
        F.lit(USER).alias("src_tipo"),
        F.col("user_id").alias("src"),
        F.lit(COUNTRY).alias("dst_tipo"),
        F.col("card_country").alias("dst"),
        F.lit(PAYMENT_EDGE).alias("relacion"),
    ).dropna(subset=["src", "dst"])


def visit_edges(visits: DataFrame) -> DataFrame:
    """Address to user, each pair once."""
    return (
        visits.select(
            F.lit(ADDRESS).alias("src_tipo"),
            F.col("ip").alias("src"),
            F.lit(USER).alias("dst_tipo"),
            F.col("user_id").alias("dst"),
            F.lit(VISIT_EDGE).alias("relacion"),
        )
        .dropna(subset=["src", "dst"])
        .distinct()
    )


def edges(payments: DataFrame, visits: DataFrame) -> DataFrame:
    return payment_edges(payments).unionByName(visit_edges(visits))


def folded(payments: DataFrame, visits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs of ends, payments with their number ``n``: enough for all vertices and edges.

    Written to the checkpoint folder, because vertices, components and ring edges all read them: the
    payments and visits behind them are read once.
    """
    ensure_checkpoint_dir(payments.sparkSession)
    paid = payments.groupBy("user_id", "card_country").agg(F.count(F.lit(1)).alias("n"))
    seen = visits.select("user_id", "ip").distinct()
    return paid.checkpoint(), seen.checkpoint()


def folded_edges(paid: DataFrame, seen: DataFrame) -> DataFrame:
    """Each edge of :func:`edges` once, with the number ``n`` of its copies, from :func:`folded` pairs."""
    # A visit edge counts once, however many visits it stands for.
    seen = seen.select(F.lit(ADDRESS).alias("src_tipo"), F.col("ip").alias("src"), F.lit(USER).alias("dst_tipo"),
                       F.col("user_id").alias("dst"), F.lit(VISIT_EDGE).alias("relacion"), F.lit(1).cast("long").alias("n"))
    paid = paid.select(F.lit(USER).alias("src_tipo"), F.col("user_id").alias("src"), F.lit(COUNTRY).alias("dst_tipo"),
                       F.col("card_country").alias("dst"), F.lit(PAYMENT_EDGE).alias("relacion"), "n")
    return paid.unionByName(seen).dropna(subset=["src", "dst"])


def degrees(edge_rows: DataFrame) -> DataFrame:
    """Edge ends per vertex. Each edge yields both ends in one scan, counted before the shuffle."""
    ends = F.explode(
        F.array(
            F.struct(F.col("src_tipo").alias("tipo"), F.col("src").alias("id")),
            F.struct(F.col("dst_tipo").alias("tipo"), F.col("dst").alias("id")),
        )
    ).alias("end")
    return (
        edge_rows.select(ends)
        .groupBy("end.tipo", "end.id")
        .agg(F.count(F.lit(1)).alias("degree"))
        .select("id", "tipo", "degree")
    )


def hot_nodes(edge_rows: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` vertices of highest degree per type.

    The edge ends carry the vertex type, so degrees need no join with the vertex table. The rank
    cut runs inside each map task first, so only ``n`` rows per type and task shuffle.
    """
    by_degree = Window.partitionBy("tipo").orderBy(F.desc("degree"), "id")
    return (
        degrees(edge_rows)
        .withColumn("tipo", F.upper("tipo"))
        .withColumn("ranking", F.row_number().over(by_degree))
        .filter(F.col("ranking") <= n)
        .drop("ranking")
        .select("id", "degree", "tipo")
    )


def of_type(nodes: DataFrame, tipo: str = ALL) -> DataFrame:
    return nodes if tipo == ALL else nodes.filter(F.col("tipo") == tipo)
