import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.functions import threat
from riskloom.operators import graph, rings
from riskloom.operators.components import connected_components

EDGE = "src_tipo string, src string, dst_tipo string, dst string, relacion string"


def build(spark, pairs, extra=()):
    edges = spark.createDataFrame([("ip", a, "usuario", b, "visita") for a, b in pairs], EDGE)
    nodes = {("ip", a) for a, _ in pairs} | {("usuario", b) for _, b in pairs} | set(extra)
    vertices = spark.createDataFrame(sorted(nodes), "tipo string, id string")
    return vertices, edges


def expected(vertices, pairs):
    parent = {f"{t}:{i}": f"{t}:{i}" for t, i in vertices}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        low, high = sorted([find(f"ip:{a}"), find(f"usuario:{b}")])
        parent[high] = low
    return {key: find(key) for key in parent}


def labels(df):
    return {f"{r.tipo}:{r.id}": r.component for r in df.collect()}


def check(spark, pairs, extra=(), **options):
    vertices, edges = build(spark, pairs, extra)
    nodes = [(r.tipo, r.id) for r in vertices.collect()]
    got = connected_components(vertices, edges, **options)
    assert labels(got) == expected(nodes, pairs)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=1, max_size=20))
def test_components_against_union_find(spark, pairs):
    check(spark, [(str(a), str(b)) for a, b in pairs], [("pais", "ES")])


def test_long_path(spark):
    chain = [(str(i), str(i)) for i in range(60)] + [(str(i + 1), str(i)) for i in range(59)]
    random.Random(1).shuffle(chain)
    check(spark, chain, rounds=1)


def test_hubs_are_taken_out_of_the_shuffle(spark, monkeypatch):
    hub = [("hub", f"u{i}") for i in range(80)] + [(f"x{i}", f"u{i}") for i in range(0, 80, 3)]
    check(spark, hub + [("far", "w"), ("far", "z")], min_hot_rows=10)
    monkeypatch.setattr("riskloom.operators.components.fits_broadcast", lambda df: False)
    check(spark, hub, min_hot_rows=10)


def test_graph_without_edges(spark):
    edges = spark.createDataFrame([], EDGE)
    alone = spark.createDataFrame([("ip", "a"), ("pais", "ES")], "tipo string, id string")
    assert labels(connected_components(alone, edges)) == {"ip:a": "ip:a", "pais:ES": "pais:ES"}
    assert connected_components(alone.limit(0), edges).count() == 0


def test_same_id_of_two_types_stays_apart(spark):
    check(spark, [("a", "b"), ("c", "a")])


def test_vertices_edges_and_degrees(spark):
    payments = spark.createDataFrame(
        [("t1", "u1", 1.0, "EUR", "ES", "V", False), ("t2", "u1", 1.0, "EUR", "ES", "V", False),
         ("t3", "u2", 1.0, "EUR", None, "V", False), ("t4", None, 1.0, "EUR", "FR", "V", False)],
        schemas.PAYMENT,
    )
    visits = spark.createDataFrame(
        [("t", "u1", "1.1.1.1", 1, 1, False, False)] * 3
        + [("t", "u3", None, 1, 1, False, False)],
        schemas.VISIT,
    )
    vertices = graph.vertices(payments, visits)
    assert {(r.tipo, r.id) for r in vertices.collect()} == {
        ("usuario", "u1"), ("usuario", "u2"), ("usuario", "u3"),
        ("pais", "ES"), ("pais", "FR"), ("ip", "1.1.1.1"),
    }
    edges = graph.edges(payments, visits)
    assert edges.filter("relacion = 'pago'").count() == 2
    assert edges.filter("relacion = 'visita'").count() == 1
    degrees = {(r.tipo, r.id): r.degree for r in graph.degrees(edges).collect()}
    assert degrees == {("usuario", "u1"): 3, ("pais", "ES"): 2, ("ip", "1.1.1.1"): 1}


def test_hub_cut_breaks_ties_by_id(spark):
    _, edges = build(spark, [(f"ip{i:02d}", f"u{i:02d}") for i in range(20)])
    top = graph.hot_nodes(edges)
    assert top.filter("tipo = 'IP'").count() == 15
    assert {r.id for r in top.filter("tipo = 'USUARIO'").collect()} == {f"u{i:02d}" for i in range(15)}


@pytest.fixture
def members(spark):
    groups = {
        "c1": ["FRAUD_USER_1", "GUEST_1", "RU"],
        "c2": ["GUEST_7", "45.33.22.11", "ES"],
        "c3": ["ab12", "cd34", "es"],
        "c4": ["ab99", "192.168.1.1", "ef56"],
        "c5": ["solo", "pair"],
        "c6": ["1.222.15.4", "x", "y"],
    }
    rows = [(c, "usuario", m) for c, names in groups.items() for m in names]
    return spark.createDataFrame(rows, "component string, tipo string, id string")


LEVELS = {
    "c1": threat.CRITICAL, "c2": threat.ELEVATED, "c3": threat.SAFE, "c4": threat.INFO,
    "c6": threat.CRITICAL,
}


def test_severity_by_members_and_by_text_agree(members):
    ring_rows = rings.ring_members(members)
    got = {r.component: r.nivel_amenaza for r in rings.ring_severity(ring_rows).collect()}
    assert got == LEVELS
    lists = ring_rows.groupBy("component").agg(F.concat_ws(", ", F.collect_list("id")).alias("miembros"))
    text = lists.withColumn("level", threat.threat_level(F.col("miembros")))
    assert {r.component: r.level for r in text.collect()} == LEVELS


def test_triage_list(members):
    ring_rows = rings.ring_members(members, min_hot_rows=1)
    severity = rings.ring_severity(ring_rows)
    quiet = rings.triage(ring_rows, severity, min_hot_rows=1)
    assert quiet.columns == [
        "Severidad", "ID Comunidad", "Nº Nodos", "Entidad Implicada"
    ]
    assert quiet.select("ID Comunidad").distinct().count() == 3
    everyone = rings.triage(ring_rows, severity, show_safe=True)
    assert everyone.count() == ring_rows.count()
    assert everyone.select("ID Comunidad").distinct().count() == 5
    kept = severity.filter(threat.is_dangerous(F.col("nivel_amenaza"), include_safe=True))
    assert kept.count() == 4


@pytest.mark.parametrize("n", [1001, 5000])
def test_large_rings_have_the_shape_of_small_ones(spark, n):
    members = spark.range(n).select(
        F.lit("c").alias("component"), F.lit("ip").alias("tipo"),
        F.concat(F.lit("m"), "id").alias("id"),
    )
    ring_rows = rings.ring_members(members, min_hot_rows=100)
    assert [tuple(r) for r in rings.fraud_rings(ring_rows).collect()] == [("c", n)]
    assert {r.id for r in rings.ring_lookup(ring_rows, "c").collect()} == {f"m{i}" for i in range(n)}


def test_node_types(spark):
    rows = [("10.0.0.1", "IP"), ("ES", "PAIS"), ("es", "USUARIO"), ("A1", "PAIS"),
            ("12", "USUARIO"), ("ESP", "USUARIO"), ("0a34b8a5", "USUARIO")]
    df = spark.createDataFrame(rows, "id string, want string")
    got = df.select("want", threat.node_type(F.col("id")).alias("got")).collect()
    assert all(r.want == r.got for r in got)


def test_topology_and_real_edges(spark):
    vertices, edges = build(spark, [("1.1", "a"), ("1.1", "b"), ("2.2", "b"), ("9.9", "z")])
    ring_rows = rings.ring_members(connected_components(vertices, edges))
    topology = rings.ring_topology(ring_rows).collect()
    assert [tuple(r)[1:] for r in topology] == [(2, 2, 0, 4, 0)]
    doubled = edges.unionByName(edges)
    got = rings.ring_edges(ring_rows, doubled, min_hot_rows=1)
    assert {(r.src, r.dst, r.n) for r in got.collect()} == {
        ("1.1", "a", 2), ("1.1", "b", 2), ("2.2", "b", 2)
    }


def test_folded_pairs_give_the_same_graph(spark):
    payments = spark.createDataFrame(
        [("t1", "u1", 1.0, "EUR", "ES", "V", False), ("t2", "u1", 1.0, "EUR", "ES", "V", False),
         ("t3", "u2", 1.0, "EUR", None, "V", False), ("t4", None, 1.0, "EUR", "FR", "V", False)],
        schemas.PAYMENT,
    )
    visits = spark.createDataFrame(
        [("t", "u1", "1.1.1.1", 1, 1, False, False)] * 3 + [("t", None, "2.2.2.2", 1, 1, False, False)], schemas.VISIT
    )
    plain, pairs = (graph.vertices(payments, visits), graph.edges(payments, visits)), graph.folded(payments, visits)
    once = graph.vertices(*pairs), graph.folded_edges(*pairs)
    assert sorted(map(tuple, once[0].collect())) == sorted(map(tuple, plain[0].collect()))
    for vertices, edges in (plain, once):
        ring_rows = rings.ring_members(connected_components(vertices, edges))
        got = {(r.relacion, r.src, r.dst, r.n) for r in rings.ring_edges(ring_rows, edges).collect()}
        assert got == {("pago", "u1", "ES", 2), ("visita", "1.1.1.1", "u1", 1)}


def test_ring_queries_read_payments_and_visits_once(spark):
    """After the pairs are written, no plan reads the tables again."""
    from riskloom.plans import queries

    members, edges = queries._rings(spark, "/root/testdata/sf0.001")
    plan = rings.ring_edges(members, edges)._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" not in plan and "RDD" in plan
