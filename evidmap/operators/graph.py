"""Knowledge graph (G1-G4) and the graph queries V7 and V8.

A graph is two frames: nodes(id, type) and links(source, target, ...).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidmap.functions.text import first_filled
from evidmap.operators.relevance import without_error
from evidmap.runtime import cut_lineage, stored


def _pairs(extractions: DataFrame) -> DataFrame:
    """One row per usable pair, with ``written``: its place in the order of writing."""
    group = first_filled(
        F.col("population.disease_stage"), F.col("population.sex"), default="general"
    )
    pairs = without_error(extractions).select(
        "pubmed_id",
        "extracted_ts",
        group.alias("population"),
        F.posexplode("treatment_outcomes").alias("pos", "pair"),
    )
    return pairs.select(
        F.lower("pair.treatment").alias("source"),
        F.lower("pair.outcome").alias("target"),
        F.coalesce("pair.effect_direction", F.lit("unknown")).alias("effect_direction"),
        "population",
        F.struct("extracted_ts", "pubmed_id", "pos").alias("written"),
    ).where((F.col("source") != "") & (F.col("target") != ""))


def _last_pairs(extractions: DataFrame) -> DataFrame:
    """(source, target, last): of the pairs of a link the one written last.

    First the last time of each link, a number that is folded without sorting; names and ids are
    compared among the pairs of that time only. Spark broadcasts the times if they are few.
    """
    pairs = _pairs(extractions)
    time = F.col("written.extracted_ts")
    times = stored(pairs.groupBy("source", "target").agg(F.max(time).alias("time")), "times")
    p, t = pairs.alias("p"), times.alias("t")
    of_link = F.col("p.source").eqNullSafe(F.col("t.source")) & F.col("p.target").eqNullSafe(F.col("t.target"))
    pairs = p.join(t, of_link & F.col("p.written.extracted_ts").eqNullSafe(F.col("t.time")), "left_semi")
    # the place in the order of writing comes first, so the largest is the last written
    last = F.max(F.struct("written.*", "effect_direction", "population"))
    return pairs.groupBy("source", "target").agg(last.alias("last"))


def _links(last_pairs: DataFrame) -> DataFrame:
    return last_pairs.select("source", "target", "last.effect_direction", "last.population", "last.pubmed_id")


def _nodes(last_pairs: DataFrame) -> DataFrame:
    # what is written last of a name is so of one of its links
    ends = F.array(
        F.struct(F.col("source").alias("id"), F.lit(0).alias("role")),
        F.struct(F.col("target").alias("id"), F.lit(1).alias("role")),
    )
    written = F.struct("last.extracted_ts", "last.pubmed_id", "last.pos").alias("written")
    role = F.max(F.struct("written", "role"))["role"]
    return (
        last_pairs.select(written, F.inline(ends))
        .groupBy("id")
        .agg(role.alias("role"))
        .select(
            "id",
            F.when(F.col("role") == 1, F.lit("outcome")).otherwise(F.lit("treatment")).alias("type"),
        )
    )


def graph_links(extractions: DataFrame) -> DataFrame:
    """G1: one link per (treatment, outcome); the last pair written gives its attributes."""
    return _links(_last_pairs(extractions))


def graph_nodes(extractions: DataFrame) -> DataFrame:
    """All link ends; a name in both roles has the type written last."""
    return _nodes(_last_pairs(extractions))


def knowledge_graph(extractions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, links)."""
    last = stored(_last_pairs(extractions), "links")
    return _nodes(last), _links(last)


def graph_counts(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Numbers of nodes and links as rows (metric, total)."""
    return nodes.agg(F.count("*").alias("total")).select(
        F.lit("nodes").alias("metric"), "total"
    ).unionByName(
        links.agg(F.count("*").alias("total")).select(F.lit("links").alias("metric"), "total")
    )


def link_table(links: DataFrame, rows: int = 50) -> DataFrame:
    """The first links."""
    return (
        links.select("source", "target", "effect_direction").orderBy("source", "target").limit(rows)
    )


def term_network(pairs: DataFrame, top: int = 100) -> tuple[DataFrame, DataFrame]:
    """(nodes(id), edges(source, target, weight)) of the most frequent term pairs."""
    edges = (
        pairs.orderBy(F.desc("co_occurrence_count"), "term_a", "term_b")
        .limit(top)
        .select(
            F.col("term_a").alias("source"),
            F.col("term_b").alias("target"),
            F.col("co_occurrence_count").alias("weight"),
        )
    )
    return _ends(edges).distinct(), edges


def _ends(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array("source", "target")).alias("id"))


def k_hop(links: DataFrame, seeds: DataFrame, k: int = 2) -> DataFrame:
    """V7: nodes within ``k`` undirected links of ``seeds(id)`` with their distance.

    Each round keeps the links that touch the newest nodes (semi-join) and the
    distinct far ends not reached before. A checkpoint per round keeps the plan
    flat however large ``k`` is.
    """
    both_ways = F.array(
        F.struct(F.col("source").alias("node"), F.col("target").alias("id")),
        F.struct(F.col("target").alias("node"), F.col("source").alias("id")),
    )
    # distinct and written once: a hub has a row per neighbour, not per link, and no round
    # computes the links again
    edges = links.select(F.inline(both_ways)).where(F.col("node") != F.col("id")).distinct()
    edges = cut_lineage(edges)
    newest = seeds.select("id").distinct()
    reached = newest.withColumn("distance", F.lit(0))
    for distance in range(1, k + 1):
        touching = edges.join(newest.withColumnRenamed("id", "node"), "node", "left_semi")
        newest = touching.select("id").distinct().join(reached, "id", "left_anti")
        if distance < k:
            newest = cut_lineage(newest)
        reached = reached.unionByName(newest.withColumn("distance", F.lit(distance)))
    return reached


def nodes_with(nodes: DataFrame, property_name: str, values: Sequence[str]) -> DataFrame:
    """V8: nodes whose property is one of ``values``; empty values never count."""
    value = F.col(property_name).cast("string")
    return nodes.where((value != "") & value.isin(*values))


def nodes_of_links_with(
    nodes: DataFrame, links: DataFrame, property_name: str, values: Sequence[str]
) -> DataFrame:
    """V8: nodes at either end of the links whose property is one of ``values``."""
    ends = _ends(nodes_with(links, property_name, values)).distinct()
    return nodes.join(ends, "id", "left_semi")
