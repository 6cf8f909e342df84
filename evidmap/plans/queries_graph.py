"""Catalogue: knowledge graph (G) and graph queries (V7, V8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidmap.operators import evidence, graph
from evidmap.plans.catalog import query
from evidmap.plans.oracle import with_tables
from evidmap.sources import testdata


@query("g1_graph_links", with_tables("links", "SELECT * FROM links"))
def g1(spark, folder):
    return graph.graph_links(testdata.line_extractions(spark, folder, heavy=True))


@query("g2_graph_nodes", with_tables("nodes", "SELECT * FROM nodes"))
def g2(spark, folder):
    return graph.graph_nodes(testdata.line_extractions(spark, folder, heavy=True))


@query(
    "g3_graph_counts",
    with_tables(
        "nodes links",
        """SELECT 'nodes' AS metric, count(*) AS total FROM nodes
UNION ALL SELECT 'links', count(*) FROM links""",
    ),
)
def g3(spark, folder):
    return graph.graph_counts(*graph.knowledge_graph(testdata.line_extractions(spark, folder, heavy=True)))


@query(
    "g3_link_table",
    with_tables(
        "links",
        "SELECT source, target, effect_direction FROM links ORDER BY source, target LIMIT 50",
    ),
)
def g3_links(spark, folder):
    return graph.link_table(g1(spark, folder))


_TOP = """, top AS (
  SELECT * FROM term_pairs ORDER BY co_occurrence_count DESC, term_a, term_b LIMIT 100)"""


@query(
    "g4_term_network_nodes",
    with_tables("term_pairs", "").rstrip()
    + _TOP
    + " SELECT term_a AS id FROM top UNION SELECT term_b FROM top",
)
def g4_nodes(spark, folder):
    return _network(spark, folder)[0]


@query(
    "g4_term_network_edges",
    with_tables("term_pairs", "").rstrip()
    + _TOP
    + " SELECT term_a AS source, term_b AS target, co_occurrence_count AS weight FROM top",
)
def g4_edges(spark, folder):
    return _network(spark, folder)[1]


def _network(spark, folder):
    return graph.term_network(
        evidence.mesh_cooccurrence(testdata.line_articles(spark, folder)), top=100
    )


_HOPS = """,
edges AS (SELECT source AS a, target AS b FROM links UNION SELECT target, source FROM links),
walk AS (
  SELECT id, 0 AS distance FROM nodes WHERE id IN ('brand#1', 'blue bolt')
  UNION SELECT b, distance + 1 FROM walk JOIN edges ON a = id WHERE distance < 2)
SELECT id, CAST(min(distance) AS INTEGER) AS distance FROM walk GROUP BY id"""


@query("v7_k_hop", with_tables("nodes links", "", recursive=True).rstrip() + _HOPS)
def v7(spark, folder):
    nodes, links = graph.knowledge_graph(testdata.line_extractions(spark, folder, heavy=True))
    seeds = nodes.where(F.col("id").isin("brand#1", "blue bolt"))
    return graph.k_hop(links, seeds, k=2)


@query(
    "v7_k_hop_order_part",
    """WITH RECURSIVE
edges AS (SELECT DISTINCT 'order ' || l_orderkey AS a, 'part ' || l_partkey AS b FROM lineitem),
both_ways AS (SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges),
walk AS (
  SELECT 'order ' || o_orderkey AS id, 0 AS distance FROM orders WHERE o_custkey = 7
  UNION SELECT b, distance + 1 FROM walk JOIN both_ways ON a = id WHERE distance < 3)
SELECT id, CAST(min(distance) AS INTEGER) AS distance FROM walk GROUP BY id""",
)
def v7_orders(spark, folder):
    # sparser than the knowledge graph: three links do not reach every node
    links = testdata.table(spark, folder, "lineitem").select(
        F.concat(F.lit("order "), "l_orderkey").alias("source"),
        F.concat(F.lit("part "), "l_partkey").alias("target"),
    )
    seeds = (
        testdata.table(spark, folder, "orders")
        .where(F.col("o_custkey") == 7)
        .select(F.concat(F.lit("order "), "o_orderkey").alias("id"))
    )
    return graph.k_hop(links, seeds, k=3)


@query(
    "v8_nodes_by_property",
    with_tables("nodes", "SELECT * FROM nodes WHERE type IN ('outcome')"),
)
def v8_nodes(spark, folder):
    return graph.nodes_with(g2(spark, folder), "type", ["outcome"])


@query(
    "v8_nodes_by_link_property",
    with_tables(
        "nodes links",
        """SELECT * FROM nodes WHERE id IN (
  SELECT source FROM links WHERE population IN ('stage IV')
  UNION SELECT target FROM links WHERE population IN ('stage IV'))""",
    ),
)
def v8_links(spark, folder):
    nodes, links = graph.knowledge_graph(testdata.line_extractions(spark, folder, heavy=True))
    return graph.nodes_of_links_with(nodes, links, "population", ["stage IV"])
