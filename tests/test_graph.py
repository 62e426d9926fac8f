"""Graph rounds against small computations: ranks, components, communities, paths, and the plan of a round."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.operators import entities, graph
from broadsheet.session import written

EDGE = "src string, dst string, type string, confidence double"


def frame(spark, pairs):
    return spark.createDataFrame([(a, b, f"t{len(a + b) % 3}", 1.0) for a, b in pairs], EDGE)


def some_edges(seed, n=30, m=90):
    rng = random.Random(seed)
    pairs = {(f"n{rng.randrange(n)}", f"n{rng.randrange(n)}") for _ in range(m)} | {("hub", f"n{i}") for i in range(0, n, 2)} | {(f"n{i}", "hub") for i in range(1, n, 3)}
    return sorted((a, b) for a, b in pairs if a != b)


def ranks(pairs, rounds, d=0.85):
    nodes = sorted({x for p in pairs for x in p})
    at = {x: i for i, x in enumerate(nodes)}
    m, out = np.zeros((len(nodes), len(nodes))), np.zeros(len(nodes))
    for a, b in pairs:
        out[at[a]] += 1
        m[at[b], at[a]] = 1
    r = np.full(len(nodes), 1 / len(nodes))
    for _ in range(rounds):
        r = (1 - d) / len(nodes) + d * (m @ np.divide(r, out, out=np.zeros_like(r), where=out > 0) + r[out == 0].sum() / len(nodes))
    return dict(zip(nodes, r))


@pytest.mark.parametrize("hub_edges", [None, 5])
def test_pagerank_equals_dense_rounds(spark, hub_edges):
    pairs = some_edges(1) + [("n1", "sink"), ("n2", "sink")]
    got = {r.id: r.rank for r in graph.pagerank(frame(spark, pairs + pairs[:9]), 4, hub_edges=hub_edges).collect()}
    want = ranks(pairs, 4)
    assert set(got) == set(want) and max(abs(got[x] - want[x]) for x in want) < 1e-12 and abs(sum(got.values()) - 1) < 1e-9


def test_pagerank_stops_when_little_moves(spark):
    pairs = some_edges(2, 12, 30)
    got = {r.id: r.rank for r in graph.pagerank(frame(spark, pairs), 25, residual=2e-2).collect()}
    want = ranks(pairs, 300)
    assert max(abs(got[x] - want[x]) for x in want) < 5e-2 and got != pytest.approx(want, abs=1e-12)
    assert graph.pagerank(frame(spark, [])).count() == 0


def test_a_round_of_pagerank_has_one_exchange(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        edges = frame(spark, some_edges(3)).select("src", "dst", F.lit(1.0).alias("w"))
        with graph.Buckets(spark) as b:
            plain, many, hubs = b.split(edges, "src", edges.groupBy("src").agg(F.count("dst").alias("n")), 10)
            vector = b.write(edges.select(F.col("src").alias("id")).distinct().withColumn("v", F.lit(1.0)), "id")
            text = graph.pushed_along(plain, many, hubs, vector)._jdf.queryExecution().executedPlan().toString()
            assert text.count("Exchange hashpartitioning") == 1 and "Exchange SinglePartition" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


@pytest.mark.parametrize("hub_edges", [3])
def test_components_of_chains_stars_and_loops(spark, hub_edges):
    pairs = [(f"c{i:03}", f"c{i + 1:03}") for i in range(24)] + [("s", f"s{i}") for i in range(20)] + [("x", "y"), ("y", "x"), ("z", "z")]
    random.Random(4).shuffle(pairs)
    got = {r.id: r.component for r in graph.components(frame(spark, pairs), hub_edges=hub_edges).collect()}
    assert {v for k, v in got.items() if k[0] == "c"} == {"c000"} and {v for k, v in got.items() if k[0] == "s"} == {"s"}
    assert got["x"] == got["y"] == "x" and got["z"] == "z" and len(got) == 25 + 21 + 3
    stats = entities.graph_stats(frame(spark, pairs)).first()
    assert stats.components == 4 and not stats.weakly_connected


def modularity(pairs, label):
    both = {(a, b) for a, b in pairs if a != b} | {(b, a) for a, b in pairs if a != b}
    m = len(both)
    total, inside = {}, {}
    for a, b in both:
        total[label[a]] = total.get(label[a], 0) + 1
        inside[label[a]] = inside.get(label[a], 0) + (label[a] == label[b])
    return sum(inside[c] / m - (total[c] / m) ** 2 for c in total)


def test_communities_by_modularity_recover_known_groups(spark):
    rng = random.Random(6)
    groups = [[f"g{g}_{i}" for i in range(8)] for g in range(4)]
    pairs = [p for g in groups for p in itertools.combinations(g, 2) if rng.random() < 0.8]
    pairs += [(groups[g][0], groups[(g + 1) % 4][3]) for g in range(4)] + [("g0_1", "g2_5")]
    found, value = graph.communities_by_modularity(frame(spark, pairs))
    label = {r.id: r.community for r in found.collect()}
    assert all(len({label[x] for x in g}) == 1 for g in groups) and len(set(label.values())) == 4
    assert label["g1_7"] == "g1_0" and abs(value - modularity(pairs, label)) < 1e-9
    row = graph.modularity(graph.weighted_both_ways(frame(spark, pairs)), found).first()
    assert abs(row.modularity - value) < 1e-9 and row.communities == 4
    cheap = {r.id: r.community for r in graph.communities(frame(spark, pairs)).collect()}
    assert value >= modularity(pairs, cheap) - 1e-12
    hubs, again = graph.communities_by_modularity(frame(spark, pairs), hub_edges=5)
    assert {r.id: r.community for r in hubs.collect()} == label and again == value
    assert {r.id: r.community for r in graph.communities(frame(spark, pairs), hub_edges=5).collect()} == cheap


def test_values_of_all_nodes_are_not_sent_through_the_driver(spark):
    """Rows that are repeated per sub-key, and values of all nodes, look small to Spark."""
    from broadsheet.plans.sized import salted_join
    big, small = (written(spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias(c))) for c in ("x", "y"))
    hubs = written(spark.createDataFrame([], "a string, n bigint"))
    edges = written(spark.createDataFrame([("a", "b", 1.0)], "a string, b string, w double"))
    labels = written(spark.createDataFrame([("a", "a")], "id string, community string"))
    salted = salted_join(big, small, ["k"], ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in salted and "BroadcastHashJoin" not in salted
    assert "SortMergeJoin [a" in graph._meet(edges, edges.limit(0), hubs, labels, "a")._jdf.queryExecution().executedPlan().toString()


def simple_paths(pairs, a, b, most):
    out, walk = [], [[a]]
    for _ in range(most):
        walk = [[*p, y] for p in walk for x, y in pairs if x == p[-1] and y not in p]
        out += [tuple(p) for p in walk if p[-1] == b]
        walk = [p for p in walk if p[-1] != b]
    return out


@pytest.mark.parametrize("hub_edges", [3])
def test_paths_from_both_ends_equal_a_search(spark, hub_edges):
    pairs = some_edges(9, 14, 40)
    asked = [("n0", "n5"), ("hub", "n4"), ("n3", "hub"), ("n2", "n2"), ("n1", "nowhere"), ("n0", "n6")]
    two = spark.createDataFrame(asked, "a string, b string")
    found = graph.find_connections(frame(spark, pairs), two, 3, hub_edges)
    rows = found.collect()
    want = {(a, b): sorted(simple_paths(pairs, a, b, 3), key=lambda p: (len(p), p)) for a, b in asked if a != b}
    got = {}
    for r in rows:
        got.setdefault((r.a, r.b), []).append(tuple(r.path))
        assert r.length == len(r.path) - 1 and r.types == [f"t{len(x + y) % 3}" for x, y in zip(r.path, r.path[1:])]
    assert {k: sorted(v, key=lambda p: (len(p), p)) for k, v in got.items()} == {k: v for k, v in want.items() if v}
    best = {}
    for r in graph.smallest_paths(found, 5).collect():
        best.setdefault((r.a, r.b), []).append((r["rank"], tuple(r.path), r.paths))
    assert {k: sorted(v) for k, v in best.items()} == {k: [(i + 1, p, len(v)) for i, p in enumerate(v[:5])] for k, v in want.items() if v}
    near = {(r.a, r.b, r.node) for r in graph.common_neighbours(frame(spark, pairs), two).collect()}
    assert near == {(a, b, y) for a, b in asked if a != b for x, y in pairs if x == a and (b, y) in set(pairs)}
