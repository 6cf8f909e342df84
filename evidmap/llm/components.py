"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidmap.llm.tables import written


def _with_least(links: DataFrame, both: DataFrame) -> DataFrame:
    """``links`` with the least neighbour of ``u`` in ``both``.

    The minima are combined before the shuffle and have one row per node, so a node
    of very many links only makes the other side of the join large, which adaptive
    execution splits.
    """
    least = both.groupBy("u").agg(F.min("v").alias("least"))
    return links.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """(node, label): for each node of ``links`` (a, b) the least node it can reach.

    Each round points the larger neighbours of every node, then all smaller ones, at
    its least neighbour; the table of links stays as long as it was. Rounds grow with
    the logarithm of the longest path; each is a written table. Empty links give an
    empty result; a link from a node to itself counts for nothing but the node.
    """
    a, b = F.col("a"), F.col("b")
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = written(edges.distinct(), "links")
    nodes = edges.where("u = v").select("u")
    edges = edges.where("u > v")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both.where("v > u"), both).select(
            F.col("v").alias("u"), F.least("least", "u").alias("v")
        )
        large = large.distinct()
        small = _with_least(large, large)
        small = small.select(
            F.explode(
                F.array(
                    F.struct(F.col("v").alias("u"), F.col("least").alias("v")),
                    F.struct(F.col("u").alias("u"), F.col("least").alias("v")),
                )
            ).alias("e")
        ).select("e.*")
        edges = written(small.where("u > v").distinct(), "links")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label"))
    alone = nodes.select(F.col("u").alias("node"), F.col("u").alias("label"))
    return stars.unionByName(roots).unionByName(alone).groupBy("node").agg(
        F.min("label").alias("label")
    )
