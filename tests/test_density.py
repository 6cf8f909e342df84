"""M2 by trees of density, and the graph of neighbours under it, against plain loops."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from evidmap.operators import density, embed, neighbours


def lists_by_loop(points, k):
    found = {}
    for p, v in points.items():
        far = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(v, w))), q) for q, w in points.items() if q != p)
        found[p] = far[:k]
    return found


def edges_by_loop(lists, min_points):
    core = {p: near[min(min_points, len(near)) - 1][0] if near else 0.0 for p, near in lists.items()}
    edges = {}
    for p, near in lists.items():
        for d, q in near:
            a, b = min(p, q), max(p, q)
            edges[a, b] = max(d, core[a], core[b], density.LEAST_WEIGHT)
    return sorted((w, a, b) for (a, b), w in edges.items())


def forest_by_loop(points, edges):
    up = {p: p for p in points}

    def find(p):
        while up[p] != p:
            p = up[p]
        return p

    chosen = []
    for w, a, b in edges:
        if find(a) != find(b):
            up[find(b)] = find(a)
            chosen.append((w, a, b))
    return chosen


def clusters_by_loop(points, edges, least):
    """Labels of the whole hierarchy, built and condensed from the top down."""
    group, tops = {p: {"points": [p]} for p in points}, {id(p): None for p in points}
    node_of = dict(group)
    for w, a, b in forest_by_loop(points, edges):
        left, right = node_of[a], node_of[b]
        node = {"points": left["points"] + right["points"], "sides": (left, right), "weight": w}
        for p in node["points"]:
            node_of[p] = node
    tops = list({id(n): n for n in node_of.values()}.values())
    labels = {}

    def condense(node, birth):
        cluster = {"points": set(node["points"]), "mass": 0.0, "birth": birth, "inner": [], "own": set()}
        while True:
            left, right = node["sides"]
            by = 1 / node["weight"]
            large = [s for s in (left, right) if len(s["points"]) >= least]
            if len(large) == 2:
                cluster["mass"] += len(node["points"]) * by
                cluster["inner"] = [condense(s, by) for s in large]
                cluster["members"] = set(node["points"]) | cluster["own"]
                break
            small = [p for s in (left, right) if len(s["points"]) < least for p in s["points"]]
            cluster["mass"] += len(small) * by
            cluster["own"] |= set(small)
            if not large:
                cluster["members"] = cluster["own"]
                break
            node = large[0]
        cluster["stability"] = cluster["mass"] - len(cluster["points"]) * birth
        within = sum(c["best"] for c in cluster["inner"])
        cluster["chosen"] = not cluster["inner"] or cluster["stability"] >= within
        cluster["best"] = cluster["stability"] if cluster["chosen"] else within
        return cluster

    def collect(cluster, whole):
        if cluster["chosen"] and not whole:
            for p in cluster["points"]:
                labels[p] = min(cluster["points"])
        else:
            for inner in cluster["inner"]:
                collect(inner, False)

    for top in tops:
        if len(top["points"]) >= least:
            collect(condense(top, 0.0), len(tops) == 1)
    order = {first: n for n, first in enumerate(sorted(set(labels.values())))}
    return {p: order[labels[p]] if p in labels else density.NOISE for p in points}


def planted(seed):
    """Groups whose densities differ a hundredfold, two of them close, and noise."""
    rng = random.Random(seed)
    points = {}
    for x, y, n, spread in ((0, 0, 40, 0.05), (0.6, 0, 40, 0.05), (8, 8, 45, 1.2), (-9, 5, 12, 0.4)):
        for _ in range(n):
            points[len(points)] = (rng.gauss(x, spread), rng.gauss(y, spread))
    for _ in range(18):
        points[len(points)] = (rng.uniform(-14, 14), rng.uniform(-14, 14))
    return points


def graph_of(spark, lists):
    rows = [(p, near) for p, near in lists.items()]
    return spark.createDataFrame(rows, "id bigint, neighbours array<struct<distance:double,other:bigint>>").repartition(4)


@pytest.mark.parametrize(("seed", "k", "least"), [(1, 12, 8), (3, 136, 5)])
def test_clusters_of_varying_density(spark, seed, k, least):
    points = planted(seed)
    lists = lists_by_loop(points, k)
    want = clusters_by_loop(points, edges_by_loop(lists, 5), least)
    found = density.density_tree_clusters(graph_of(spark, lists), 5, least).collect()
    assert {r.id: r.cluster for r in found} == want
    # the two dense groups and the sparse one, apart
    homes = [{want[p] for p in range(a, b)} - {density.NOISE} for a, b in ((0, 40), (40, 80), (80, 125))]
    assert all(homes) and not (homes[0] & homes[1] or homes[1] & homes[2])


def test_equal_points_and_equal_weights(spark):
    points = {p: (float(p % 7), float(p // 28)) for p in range(56)} | {100 + p: (50.0 + p, 0.0) for p in range(15)}
    lists = lists_by_loop(points, 9)
    want = clusters_by_loop(points, edges_by_loop(lists, 4), 5)
    found = density.density_tree_clusters(graph_of(spark, lists), 4, 5).collect()
    got = {r.id: r.cluster for r in found}
    assert set(got) == set(want) and {p for p, c in want.items() if c < 0} == {p for p, c in got.items() if c < 0}
    assert len({(got[p], want[p]) for p in points}) == len(set(want.values()))


def test_long_ways_of_small_components(spark):
    """Gaps that grow along a line: every point's nearest edge leads to the one before."""
    points = {p: (1.1**p, 0.0) for p in range(60)}
    lists = lists_by_loop(points, 4)
    edges = edges_by_loop(lists, 1)
    weighted = density.mutual_reachability(graph_of(spark, lists), 1)
    for one_task in (0, 10, 10**6):
        forest = density.spanning_forest(weighted, one_task)
        assert sorted((r.weight, r.a, r.b) for r in forest.collect()) == forest_by_loop(points, edges)
    found = density.density_tree_clusters(graph_of(spark, lists), 1, 4).collect()
    assert {r.id: r.cluster for r in found} == clusters_by_loop(points, edges, 4)


def test_no_points_and_one(spark):
    empty = graph_of(spark, {0: []}).limit(0)
    assert density.density_tree_clusters(empty).collect() == []
    assert [tuple(r) for r in density.density_tree_clusters(graph_of(spark, {7: []})).collect()] == [(7, density.NOISE)]


def mixture(n, size, groups, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, size))
    return centres[rng.integers(0, groups, n)] + rng.normal(size=(n, size)) * 0.5


def vectors_of(spark, data):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    return spark.createDataFrame(rows, "id bigint, vector array<double>").repartition(5)


def test_neighbours_of_few_vectors_are_exact(spark):
    data = np.round(3 * mixture(150, 4, 5, 1))  # whole numbers: equal distances
    odd = spark.createDataFrame([(500, None), (501, [1.0]), (502, [math.nan] * 4), (None, [0.0] * 4)], "id bigint, vector array<double>")
    found = neighbours.neighbour_graph(vectors_of(spark, data).unionByName(odd), k=6).collect()
    want = lists_by_loop({i: tuple(v) for i, v in enumerate(data)}, 6)
    assert {r.id for r in found} == set(want)
    for r in found:
        assert [n.other for n in r.neighbours] == [q for _, q in want[r.id]]
        assert [n.distance for n in r.neighbours] == pytest.approx([d for d, _ in want[r.id]])


def test_recall_of_neighbours(spark):
    """Blocks far smaller than the table, and a group of equal vectors."""
    data = mixture(2500, 24, 30, 2)
    data[1000:1400] = data[1000]
    found = neighbours.neighbour_graph(vectors_of(spark, data), k=10, block=64).collect()
    far = neighbours._squared(data, data)
    np.fill_diagonal(far, np.inf)
    worst = np.sqrt(np.sort(far, axis=1)[:, 9]) + 1e-9
    # any of the equal ones is as good as another
    hits = [sum(n.distance <= worst[r.id] for n in r.neighbours) / 10 for r in found]
    assert len(found) == 2500 and all(len({n.other for n in r.neighbours}) == 10 for r in found)
    assert np.mean(hits) >= 0.9, np.mean(hits)
    assert all(n.distance == pytest.approx(math.sqrt(far[r.id, n.other])) for r in found[:50] for n in r.neighbours)


def test_layout_against_numpy(spark):
    data = np.concatenate([mixture(60, 3, 1, s) * 0.3 + 1.5 * s for s in range(3)])
    graph = neighbours.neighbour_graph(vectors_of(spark, data), k=12).cache()
    lists = {r.id: [n.other for n in r.neighbours] for r in graph.collect()}
    links = np.zeros((180, 180))
    for p, near in lists.items():
        links[p, near] = links[near, p] = 1
    root = np.sqrt(links.sum(1))
    values, axes = np.linalg.eigh((np.eye(180) + links / np.outer(root, root)) / 2)
    rows = neighbours.spectral_layout(graph, iterations=120, every=10).orderBy("id").collect()
    found = np.array([[r.x, r.y] for r in rows]) * root[:, None]
    # in the space of the first three directions, at right angles to the trivial one
    assert np.linalg.norm(axes[:, -3:].T @ found, axis=0) == pytest.approx([1, 1], abs=0.02)
    assert np.abs(root @ found) / np.linalg.norm(root) == pytest.approx([0, 0], abs=1e-6)
    assert found[:, 0] @ found[:, 1] == pytest.approx(0, abs=1e-6)


def test_planted_groups_in_the_layout(spark):
    rng = np.random.default_rng(5)
    data = np.concatenate([rng.normal(size=(50, 12)) * s + np.eye(12)[c] * 9 for c, s in enumerate((0.2, 0.6, 1.2))])
    frame = vectors_of(spark, data).select(F.col("id").cast("string").alias("pubmed_id"), F.col("vector").alias("embedding"))
    rows = embed.map_embeddings(frame, k=15, min_points=5, min_cluster_size=20).collect()
    assert [c for c in rows[0].asDict()] == ["pubmed_id", "x", "y", "cluster"] and len(rows) == 150
    homes = [[r.cluster for r in rows if int(r.pubmed_id) // 50 == g] for g in range(3)]
    main = [max(set(h), key=h.count) for h in homes]
    assert len(set(main)) == 3 and density.NOISE not in main
    assert all(h.count(m) >= 40 for h, m in zip(homes, main))


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "pubmed_id string, embedding array<float>")
    assert embed.map_embeddings(empty).collect() == []


def test_one_task_and_rounds_give_the_same_clusters(spark):
    """Clusters that join one by one; a forest, and a tree, that one task takes or rounds do."""
    rng = random.Random(3)
    points = {i: (rng.gauss(i % 4 * 3, 1 + i % 3), rng.gauss(0, 1)) for i in range(300)}
    lists = lists_by_loop(points, 10)
    want = clusters_by_loop(points, edges_by_loop(lists, 4), 6)
    assert len(set(want.values())) > 8
    for one_task in (density.ONE_TASK, 40):
        found = density.density_tree_clusters(graph_of(spark, lists), 4, 6, one_task).collect()
        assert {r.id: r.cluster for r in found} == want
