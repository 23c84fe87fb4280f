import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.plans import identity


def edges_of(spark, pairs):
    rows = spark.createDataFrame(pairs, "a long, b long")
    return rows.select(schema.user_person("a").alias("node1"), schema.user_person("b").alias("node2"))


def roots(df):
    return {r["id"]["user_id"]: r["root"]["user_id"] for r in df.collect()}


def brute_force(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {x: find(x) for x in parent if find(x) != x}


CHAIN = [(i, i + 1) for i in range(40)]
RING = [(i, (i + 1) % 15) for i in range(15)]
STAR = [(50, i) for i in range(30) if i != 50]
TREE = [(i, i // 2) for i in range(1, 64)]


GRAPHS = [CHAIN, RING, STAR, TREE, [(1, 1)], [(2, 1), (1, 2), (2, 1)]]


def test_components(spark):
    pairs = [(1000 * i + a, 1000 * i + b) for i, graph in enumerate(GRAPHS) for a, b in graph]
    assert roots(identity.connected_components(edges_of(spark, pairs))) == brute_force(pairs)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(-20, 20), st.integers(-20, 20)), min_size=1, max_size=40))
def test_components_of_any_graph(spark, pairs):
    assert roots(identity.connected_components(edges_of(spark, pairs))) == brute_force(pairs)


def test_no_links(spark):
    none = edges_of(spark, [(1, 1)]).where("false")
    assert identity.connected_components(none).count() == 0


def test_components_of_components(spark):
    once = identity.connected_components(edges_of(spark, CHAIN + TREE))
    again = once.select(F.col("id").alias("node1"), F.col("root").alias("node2"))
    assert roots(identity.connected_components(again)) == roots(once)


def test_cookie_wins_over_user_id(spark):
    cookie = schema.cookie_person(F.lit("zzz"))
    edges = spark.range(1).select(cookie.alias("node1"), schema.user_person(F.lit(1)).alias("node2"))
    row = identity.connected_components(edges).first()
    assert (row["id"]["user_id"], row["root"]["cookie"]) == (1, "zzz")


def test_plain_iteration_reaches_the_same_roots(spark):
    pairs = [(i, i + 1) for i in range(6)] + [(20, 3), (9, 9)]
    current = edges_of(spark, pairs)
    for _ in range(10):
        following, progress = identity.identity_iteration(current)
        found = [(r["node1"]["user_id"], r["node2"]["user_id"]) for r in following.collect()]
        if progress.isEmpty():
            break
        current = edges_of(spark, found)
    assert {high: low for low, high in found} == brute_force(pairs)


def test_one_iteration(spark, rows_of):
    directed = identity.bidirectional_edges(edges_of(spark, [(1, 3), (3, 5), (7, 7)]))
    assert directed.count() == 4
    rows = identity.iterate_edges(directed).select("node1.user_id", "node2.user_id", "is_new")
    assert rows_of(rows) == [(1, 3, False), (1, 3, True), (1, 5, True), (3, 5, False)]


def test_views_take_the_root(spark, seed_views, seed_equivs):
    found = identity.resolve_identities(seed_views, seed_equivs)
    assert found.columns == seed_views.columns
    assert {r["person"]["user_id"] for r in found.collect()} == {2, 4, 7, 8}
    assert found.count() == 11


def test_null_ids_are_not_linked(spark):
    edges = edges_of(spark, [(1, 2)])
    holes = edges.unionByName(
        edges.select(F.lit(None).cast(schema.PERSON).alias("node1"), F.lit(None).cast(schema.PERSON).alias("node2"))
    )
    assert roots(identity.connected_components(holes)) == {2: 1}
