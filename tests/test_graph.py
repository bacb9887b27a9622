"""Shortest paths and components against plain-Python references."""

import heapq
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from routecov.operators import components as comp
from routecov.operators import graph as gr
from routecov.operators import shortest_path as sp


def py_paths(edges, source):
    """Dijkstra keyed by (dist, hops, path): the same total order as the job."""
    adj = {}
    for s, d, w in edges:
        adj.setdefault(s, []).append((d, w))
    best = {}
    heap = [(0, 0, (source,))]
    while heap:
        dist, hops, path = heapq.heappop(heap)
        node = path[-1]
        if node in best:
            continue
        best[node] = (dist, hops, list(path))
        for d, w in adj.get(node, []):
            if d not in best and d not in path:
                heapq.heappush(heap, (dist + w, hops + 1, path + (d,)))
    return best


def edge_df(spark, edges):
    return spark.createDataFrame(edges, "src bigint, dst bigint, weight bigint")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_shortest_paths_match_python(spark, seed):
    rnd = random.Random(seed)
    n = 12
    edges = set()
    for _ in range(30):
        a, b = rnd.randrange(n), rnd.randrange(n)
        if a != b:
            edges.add((a, b, rnd.choice([0, 1, 1, 2, 3, 5])))  # zero weights and ties
    edges = sorted({(a, b): (a, b, w) for a, b, w in edges}.values())
    out = sp.shortest_paths(edge_df(spark, edges), spark.range(n).select(F.col("id").alias("source")))
    got = {(r["source"], r["node"]): (r["dist"], r["hops"], list(r["path"])) for r in out.collect()}
    want = {(s, t): v for s in range(n) for t, v in py_paths(edges, s).items()}
    assert got == want


def test_unreachable_pairs_have_no_path(spark):
    e = edge_df(spark, [(1, 2, 5), (2, 1, 5), (3, 4, 1), (4, 3, 1)])
    out = sp.shortest_paths(e, spark.createDataFrame([(1,), (3,)], "source bigint"))
    assert rows(out, "source", "node") == [(1, 1), (1, 2), (3, 3), (3, 4)]
    freq = spark.createDataFrame([(1, 2, 7), (1, 3, 2), (2, 2, 1)], "pu_location_id bigint, do_location_id bigint, frequency bigint")
    assert rows(sp.unreachable_pairs(freq, out), "pu_location_id", "do_location_id") == [(1, 3)]


def test_equal_length_tie_prefers_fewer_hops_then_smaller_path(spark):
    e = edge_df(spark, [(1, 2, 1), (2, 4, 1), (1, 3, 1), (3, 4, 1), (1, 4, 2)])
    out = sp.shortest_paths(e, spark.createDataFrame([(1,)], "source bigint"))
    got = {r["node"]: list(r["path"]) for r in out.collect()}
    assert got[4] == [1, 4]
    e2 = edge_df(spark, [(1, 3, 1), (3, 4, 1), (1, 2, 1), (2, 4, 1)])
    got2 = {r["node"]: list(r["path"]) for r in sp.shortest_paths(
        e2, spark.createDataFrame([(1,)], "source bigint")).collect()}
    assert got2[4] == [1, 2, 4]


def test_negative_weight_rejected(spark):
    with pytest.raises(ValueError):
        sp.shortest_paths(edge_df(spark, [(1, 2, -1)]), spark.createDataFrame([(1,)], "source bigint"))


def test_path_frequency_skips_same_zone(spark):
    e = edge_df(spark, [(1, 2, 1), (2, 3, 1), (3, 2, 1), (2, 1, 1)])
    freq = spark.createDataFrame([(1, 3, 4), (1, 1, 9), (3, 1, 2)],
                                 "pu_location_id bigint, do_location_id bigint, frequency bigint")
    got = [(list(r["trip_path"]), r["frequency"]) for r in sp.path_frequency(freq, e).collect()]
    assert sorted(got) == [([1, 2, 3], 4), ([3, 2, 1], 2)]


def py_components(n_nodes, edges):
    parent = list(range(n_nodes))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {v: min(u for u in range(n_nodes) if find(u) == find(v)) for v in range(n_nodes)}


@pytest.mark.parametrize("seed", [7, 8])
def test_components_match_union_find(spark, seed):
    rnd = random.Random(seed)
    n = 40
    edges = [(i, i + 1) for i in range(0, 20)]  # a long chain
    edges += [(rnd.randrange(20, n), rnd.randrange(20, n)) for _ in range(12)]
    e = spark.createDataFrame([(a, b, 1) for a, b in edges], "src bigint, dst bigint, weight bigint")
    nodes = spark.range(n).select(F.col("id").alias("node"))
    got = dict(rows(comp.connected_components(e, nodes), "node", "component"))
    assert got == py_components(n, edges)


def test_graph_building_blocks(spark):
    e = edge_df(spark, [(1, 2, 3), (2, 3, 4)])
    assert rows(gr.nodes(e)) == [(1,), (2,)]
    assert rows(gr.neighbours(e, 9)) == []
    added = gr.add_edges(e, spark.createDataFrame([(3, 1)], "src bigint, dst bigint"))
    assert rows(added) == [(1, 2, 3), (2, 3, 4), (3, 1, 0)]
    assert rows(gr.undirected(e)) == [(1, 2, 3), (2, 1, 3), (2, 3, 4), (3, 2, 4)]
    assert rows(gr.from_adjacency(gr.adjacency(e))) == rows(e)
    assert gr.empty_graph(spark).count() == 0


def test_readme_step3_chain_example(spark):
    """README step 3: pairs ((1,4),2), ((2,4),1), ((1,2),1), ((3,5),1) on the
    chain 1-2-3-4-5 give paths 1,2,3,4 / 2,3,4 / 1,2 / 3,4,5."""
    chain = [(a, a + 1, 1) for a in range(1, 5)]
    e = gr.undirected(edge_df(spark, chain))
    freq = spark.createDataFrame([(1, 4, 2), (2, 4, 1), (1, 2, 1), (3, 5, 1)],
                                 "pu_location_id bigint, do_location_id bigint, frequency bigint")
    got = sorted((",".join(map(str, r["trip_path"])), r["frequency"]) for r in sp.path_frequency(freq, e).collect())
    assert got == [("1,2", 1), ("1,2,3,4", 2), ("2,3,4", 1), ("3,4,5", 1)]


def test_max_dist_bounds_the_state(spark):
    e = edge_df(spark, [(1, 2, 3), (2, 3, 3), (3, 4, 3)])
    out = sp.shortest_paths(e, spark.createDataFrame([(1,)], "source bigint"), max_dist=6)
    assert rows(out, "node", "dist") == [(1, 0), (2, 3), (3, 6)]


def test_large_graph_branch_matches_broadcast_branch(spark, monkeypatch):
    e = edge_df(spark, [(a, (a * 7 + k) % 20, 1 + (a + k) % 5) for a in range(20) for k in (1, 3, 11)])
    src = spark.range(20).select(F.col("id").alias("source"))
    small = rows(sp.shortest_paths(e, src))
    monkeypatch.setattr(sp, "BROADCAST_MAX_ROWS", 0)
    assert rows(sp.shortest_paths(e, src)) == small


def test_missing_centroids_are_reported(spark):
    pairs = spark.createDataFrame([(1, 2), (2, 9)], "location_id bigint, neighbor_location_id bigint")
    cen = spark.createDataFrame([(1, 40.7, -73.9), (2, 40.8, -73.9)], "location_id bigint, avg_lat double, avg_lon double")
    assert rows(gr.missing_centroids(pairs, cen)) == [(9,)]
    assert rows(gr.neighbor_distance(pairs, cen), "location_id", "neighbor_location_id") == [(1, 2)]


def test_only_candidates_are_shuffled(spark, monkeypatch):
    """Each round's plan holds one shuffle, of the candidates; a state above one bucket is read in place."""
    from routecov.sinks import bucketed
    monkeypatch.setattr(sp, "BUCKET_ROWS", 0)
    plans, put = [], bucketed.Rounds.put

    def recorded(self, df, dealt=True):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return put(self, df, dealt)
    monkeypatch.setattr(bucketed.Rounds, "put", recorded)
    e = edge_df(spark, [(a, (a + k) % 30, 1 + (a + k) % 4) for a in range(30) for k in (1, 2, 7)])
    out = sp.shortest_paths(e, spark.range(30).select(F.col("id").alias("source")), rounds_a_write=1)
    assert out.count() == 900 and len(plans) > 3
    for plan in plans[1:]:
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("routecov_")]


def test_costs_beyond_a_long(spark):
    big = 1 << 55
    e = edge_df(spark, [(1, 2, big), (2, 3, big), (1, 3, 2 * big), (3, 4, 1), (1, 4, 2 * big + 1), (4, 1, 0), (1, 1, 5), (2, None, 1), (3, 2, None)])
    out = sp.shortest_paths(e.where("dst is not null"), spark.createDataFrame([(1,)], "source bigint"))
    assert rows(out, "node", "dist", "hops") == [(1, 0, 0), (2, big, 1), (3, 2 * big, 1), (4, 2 * big + 1, 1)]


def _py_union(edges, extra=()):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for n in extra:
        root(n)
    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return sorted((n, root(n)) for n in parent)


@pytest.mark.parametrize("shape,bound", [("chain", None), ("random", None), ("two hubs", 0), ("none", None)])
def test_components_of_shapes(spark, monkeypatch, shape, bound):
    rnd = random.Random(3)
    edges = {"chain": [(i, i + 1) for i in range(300)],
             "random": [(rnd.randrange(400), rnd.randrange(400)) for _ in range(250)],
             "two hubs": [(1000 + i % 2, i) for i in range(300)] + [(7, 7)], "none": []}[shape]
    df = spark.createDataFrame([*edges, (None, 3), (4, None)], "src bigint, dst bigint").repartition(3)
    nodes = spark.createDataFrame([(9999,), (None,), (5,)], "node bigint")
    want = _py_union(edges, (9999, 5))
    if bound is not None:  # no broadcast: hot keys are split
        monkeypatch.setattr(comp, "BROADCAST_MAX_ROWS", bound)
    assert rows(comp.connected_components(df, nodes), "node", "component") == want


def test_union_equals_a_full_run(spark):
    rnd = random.Random(8)
    seen, kept = [], comp.connected_components(spark.createDataFrame([], "src bigint, dst bigint"))
    for step in range(2):
        new = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(60)]
        seen += new
        df = spark.createDataFrame([*new, (None, 1)], "src bigint, dst bigint").repartition(3)
        kept = spark.createDataFrame(comp.union(kept, df).collect(), "node bigint, component bigint")
        assert rows(kept, "node", "component") == _py_union(seen), step
    same = comp.union(kept, spark.createDataFrame([seen[0]], "src bigint, dst bigint"))
    assert rows(same, "node", "component") == _py_union(seen)


def test_find_makes_unknown_nodes_their_own_class(spark):
    kept = comp.connected_components(edge_df(spark, [(3, 2, 1), (2, 8, 1)]))
    asked = spark.createDataFrame([(8,), (8,), (77,), (None,), (2,)], "node bigint")
    assert rows(comp.find(kept, asked), "node", "component") == [(2, 2), (8, 2), (77, 77)]
