"""Connected components and key groups: properties on small graphs."""

import random

from aurum.operators import graph


def _cc(spark, nodes, edges):
    n = spark.createDataFrame([(x,) for x in nodes], "node string")
    e = spark.createDataFrame(edges or [("x", "x")], "src string, dst string")
    return {r["node"]: r["component"] for r in graph.connected_components(n, e).collect()}


def _reference_cc(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {n: min(m for m in nodes if find(m) == find(n)) for n in nodes}


def test_chain_and_star(spark):
    nodes = [f"n{i:02d}" for i in range(12)]
    edges = [(nodes[i], nodes[i + 1]) for i in range(5)] + [("n08", "n11"), ("n10", "n11")]
    assert _cc(spark, nodes, edges) == _reference_cc(nodes, edges)


def test_random_graphs_order_independent(spark):
    rnd = random.Random(7)
    nodes = [f"v{i:03d}" for i in range(60)]
    edges = [(rnd.choice(nodes), rnd.choice(nodes)) for _ in range(45)]
    expected = _reference_cc(nodes, edges)
    assert _cc(spark, nodes, edges) == expected
    rnd.shuffle(edges)
    assert _cc(spark, list(reversed(nodes)), [(b, a) for a, b in edges]) == expected


def test_star_edges_keep_connectivity(spark):
    members = spark.createDataFrame([("g1", "b"), ("g1", "a"), ("g1", "c"), ("g2", "c"), ("g2", "d"), ("g3", "e")], "gid string, node string")
    e = graph.star_edges(members)
    n = members.select("node").distinct()
    comp = {r["node"]: r["component"] for r in graph.connected_components(n, e).collect()}
    assert comp == {"a": "a", "b": "a", "c": "a", "d": "a", "e": "e"}
    gm = {r["gid"]: (r["min1"], r["min2"]) for r in graph.group_minima(members).collect()}
    assert gm["g1"] == ("a", "b") and gm["g3"] == ("e", None)


def test_dense_number(spark):
    df = spark.createDataFrame([("B", "x"), ("A", "y"), ("A", "x"), ("B", "z"), ("A", "y")], "org string, k string")
    out = graph.dense_number(df, ["k"], ["org"], out="n", buckets=3).select("org", "k", "n").distinct().collect()
    got = sorted((r["org"], r["k"], r["n"]) for r in out)
    assert got == [("A", "x", 1), ("A", "y", 2), ("B", "x", 1), ("B", "z", 2)]
