"""Knowledge graph, graph queries, components and clusters against plain loops."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime
from math import floor

import numpy as np
import pytest
from pyspark.sql import functions as F

from evidmap.operators import embed, graph

EXTRACTIONS = (
    "pubmed_id string, extracted_ts timestamp, extraction_error string, "
    "population struct<sex:string,disease_stage:string>, "
    "treatment_outcomes array<struct<treatment:string,outcome:string,effect_direction:string>>"
)


def test_last_pair_decides(spark, rows):
    frame = spark.createDataFrame(
        [
            ("1", datetime(2024, 1, 2), None, ("female", "IV"), [("A", "B", "positive"), ("b", "c", "neutral")]),
            ("2", datetime(2024, 1, 3), None, ("female", ""), [("a", "b", "negative"), ("a", "B", "mixed"), ("", "x", "mixed")]),
            ("3", datetime(2024, 1, 1), None, None, [("a", "b", "unknown"), ("c", "d", "positive")]),
            ("4", datetime(2024, 1, 9), "failed", None, [("a", "b", "positive"), ("e", "f", "positive")]),
        ],
        EXTRACTIONS,
    )
    nodes, links = graph.knowledge_graph(frame)
    assert rows(links) == [
        ("a", "b", "mixed", "female", "2"), ("b", "c", "neutral", "IV", "1"), ("c", "d", "positive", "general", "3"),
    ]
    assert rows(nodes) == [("a", "treatment"), ("b", "outcome"), ("c", "outcome"), ("d", "outcome")]
    assert rows(graph.graph_counts(nodes, links)) == [("links", 3), ("nodes", 4)]
    assert [tuple(r) for r in graph.link_table(links, 2).collect()] == [("a", "b", "mixed"), ("b", "c", "neutral")]
    assert rows(graph.nodes_with(nodes, "type", ["treatment", ""])) == [("a", "treatment")]
    assert rows(graph.nodes_of_links_with(nodes, links, "population", ["IV", "general"]), "id") == [("b",), ("c",), ("d",)]


def test_self_link_counts_as_outcome(spark, rows):
    frame = spark.createDataFrame([("1", datetime(2024, 1, 1), None, None, [("a", "A", "positive")])], EXTRACTIONS)
    assert rows(graph.graph_nodes(frame)) == [("a", "outcome")]


def test_only_pairs_of_the_last_time_are_sorted(spark, rows):
    """Times are folded without sorting; what has none, or the same, is settled by id and place."""
    day = datetime(2024, 1, 1)
    frame = spark.createDataFrame(
        [
            ("1", None, None, None, [("a", "b", "positive"), ("n", "m", "mixed")]),
            ("2", None, None, None, [("n", "m", "neutral"), ("m", "n", "unknown")]),
            ("3", day, None, None, [("a", "b", "negative"), ("a", "b", "mixed"), ("b", "a", "positive")]),
            ("4", day, None, None, [("a", "b", "neutral"), ("A", "c", "positive")]),
        ],
        EXTRACTIONS,
    )
    links = graph.graph_links(frame)
    assert rows(links, "source", "target", "effect_direction", "pubmed_id") == [
        ("a", "b", "neutral", "4"), ("a", "c", "positive", "4"), ("b", "a", "positive", "3"),
        ("m", "n", "unknown", "2"), ("n", "m", "neutral", "2"),
    ]
    assert rows(graph.graph_nodes(frame)) == [("a", "treatment"), ("b", "outcome"), ("c", "outcome"), ("m", "treatment"), ("n", "outcome")]
    assert "LeftSemi" in links._jdf.queryExecution().optimizedPlan().toString()


def test_term_network(spark, rows):
    pairs = spark.createDataFrame([("a", "b", 5), ("b", "c", 9), ("c", "d", 1)], "term_a string, term_b string, co_occurrence_count bigint")
    nodes, edges = graph.term_network(pairs, top=2)
    assert rows(nodes) == [("a",), ("b",), ("c",)]
    assert rows(edges) == [("a", "b", 5), ("b", "c", 9)]


@pytest.mark.parametrize("k", [0, 1, 2, 4])
def test_hops_against_breadth_first_search(spark, rows, k):
    random.seed(k)
    links = [(f"n{random.randint(0, 60)}", f"n{random.randint(0, 60)}") for _ in range(60)]
    links += [("hub", f"n{i}") for i in range(20)] + [("n1", "n1")]
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    distance, newest = {"n3": 0, "n7": 0}, ["n3", "n7"]
    for step in range(1, k + 1):
        newest = {m for n in newest for m in near.get(n, ()) if m not in distance}
        distance.update({m: step for m in newest})
    frame = spark.createDataFrame(links, "source string, target string")
    seeds = spark.createDataFrame([("n3",), ("n7",), ("n3",)], "id string")
    assert rows(graph.k_hop(frame, seeds, k)) == sorted(distance.items(), key=repr)


def test_components_against_union_find(spark, rows):
    random.seed(4)
    chain = [(i, i + 1) for i in range(1000, 1200)]
    pairs = [(random.randint(0, 150), random.randint(0, 150)) for _ in range(90)] + chain
    parent = {i: i for p in pairs for i in p} | {9999: 9999}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    both = pairs + [(b, a) for a, b in pairs]
    nodes = spark.createDataFrame([(i,) for i in parent], "id bigint")
    edges = spark.createDataFrame(both, "a bigint, b bigint")
    assert rows(embed.connected_components(nodes, edges)) == sorted(((i, root(i)) for i in parent), key=repr)


def clusters_by_loop(points, radius, min_points, min_size):
    cell = {p: (floor(x / radius), floor(y / radius)) for p, (x, y) in points.items()}
    count = Counter(cell.values())

    def around(c):
        return [(c[0] + a, c[1] + b) for a in (-1, 0, 1) for b in (-1, 0, 1)]

    core = {c for c in count if sum(count[d] for d in around(c)) >= min_points}
    label = {}
    for start in sorted(core):
        todo = [start] if start not in label else []
        while todo:
            c = todo.pop()
            if c not in label:
                label[c] = start
                todo += [d for d in around(c) if d in core]
    for c in set(count) - core:
        near = [label[d] for d in around(c) if d in core]
        if near:
            label[c] = min(near)
    size = Counter()
    for c, n in count.items():
        if c in label:
            size[label[c]] += n
    return {p: label[c] if c in label and size[label[c]] >= min_size else None for p, c in cell.items()}


def test_clusters_against_a_loop(spark):
    random.seed(6)
    points = {}
    for x, y, n, spread in ((0, 0, 60, 0.3), (5, 5, 40, 0.4), (-4, 2, 8, 0.1), (2, -6, 200, 0.01)):
        for _ in range(n):
            points[f"p{len(points)}"] = (random.gauss(x, spread), random.gauss(y, spread))
    for _ in range(25):
        points[f"p{len(points)}"] = (random.uniform(-8, 8), random.uniform(-8, 8))
    expected = clusters_by_loop(points, 0.5, 6, 10)
    frame = spark.createDataFrame([(p, x, y) for p, (x, y) in points.items()], "pubmed_id string, x double, y double")
    found = {r.pubmed_id: r.cluster for r in embed.density_clusters(frame, 0.5, 6, 10).collect()}
    assert {p for p, c in found.items() if c == embed.NOISE} == {p for p, c in expected.items() if c is None}
    names = {(found[p], expected[p]) for p in points if expected[p] is not None}
    # one number per cluster and one cluster per number
    assert len(names) == len({a for a, _ in names}) == len({b for _, b in names}) == 3


def test_points_far_apart(spark, rows):
    points = [(f"{k}-{i}", 1e15 * k + 0.1 * i, -1e15 * k) for k in (-1, 1) for i in range(12)]
    found = rows(embed.density_clusters(spark.createDataFrame(points, "pubmed_id string, x double, y double"), 5.0))
    assert {(p.rsplit("-", 1)[0], c) for p, _, _, c in found} == {("-1", 0), ("1", 1)}


def test_no_cluster_at_all(spark, rows):
    frame = spark.createDataFrame([("a", 0.0, 0.0), ("b", 9.0, 9.0)], "pubmed_id string, x double, y double")
    assert rows(embed.density_clusters(frame, 1.0)) == [("a", 0.0, 0.0, -1), ("b", 9.0, 9.0, -1)]


def test_projection_against_numpy(spark):
    rng = np.random.default_rng(2)
    data = rng.normal(size=(80, 6)) * [5, 3, 1, 0.5, 0.2, 0.1]
    frame = spark.createDataFrame([(str(i), [float(v) for v in row]) for i, row in enumerate(data)], "pubmed_id string, embedding array<float>")
    found = np.array([[r.x, r.y] for r in embed.project(frame).orderBy(F.col("pubmed_id").cast("int")).collect()])
    axes = np.linalg.svd(data - data.mean(axis=0))[2][:2].T
    axes *= [1 if max(a, key=abs) > 0 else -1 for a in axes.T]
    np.testing.assert_allclose(found, data.astype("float32") @ axes, atol=1e-4)


def test_planted_blobs_are_found(spark):
    rng = np.random.default_rng(3)
    centres = np.eye(3, 8) * 10
    data = [(f"{c}-{i}", [float(v) for v in rng.normal(centres[c], 0.2)]) for c in range(3) for i in range(40)]
    frame = spark.createDataFrame(data, "pubmed_id string, embedding array<float>")
    found = embed.cluster_embeddings(frame, radius=1.0, min_points=5).collect()
    labels = {r.pubmed_id.split("-")[0]: r.cluster for r in found}
    assert len(set(labels.values())) == 3
    assert all(r.cluster == labels[r.pubmed_id.split("-")[0]] != embed.NOISE for r in found)


def test_text_embeddings(spark):
    texts = {"1": "Pain, pain and dienogest", "2": "dienogest AND surgery", "3": "surgery", "4": "surgery.", "5": None}
    frame = spark.createDataFrame(list(texts.items()), "pubmed_id string, abstract string")
    found = {r.pubmed_id: np.array(r.embedding) for r in embed.text_embeddings(frame, 64).collect()}
    assert set(found) == {"1", "2", "3", "4"}
    np.testing.assert_allclose([np.linalg.norm(v) for v in found.values()], 1.0, atol=1e-6)
    np.testing.assert_allclose(found["3"], found["4"])
    documents = [["pain", "pain", "and", "dienogest"], ["dienogest", "and", "surgery"], ["surgery"], ["surgery"]]
    idf = {w: np.log(5 / (sum(w in d for d in documents) + 1)) for d in documents for w in d}
    weights = {i: {w: d.count(w) * idf[w] for w in d} for i, d in zip("1234", documents)}
    dot = sum(v * weights["2"].get(w, 0) for w, v in weights["1"].items())
    length = [np.sqrt(sum(v * v for v in weights[i].values())) for i in "12"]
    assert found["1"] @ found["2"] == pytest.approx(dot / (length[0] * length[1]), abs=1e-5)
