"""Embeddings (M1) and their clusters (M2)."""

from __future__ import annotations


from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, PCA, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evidmap.operators import density, neighbours
from evidmap.runtime import cut_lineage

NOISE = -1


def text_embeddings(articles: DataFrame, dimensions: int = 256) -> DataFrame:
    """M1: (pubmed_id, embedding array<float>) of every abstract.

    Hashed term frequencies weighted by rarity, scaled to length 1. The fit
    keeps one document count per dimension.
    """
    texts = articles.where(F.col("abstract").isNotNull()).select("pubmed_id", "abstract")
    steps = [
        RegexTokenizer(inputCol="abstract", outputCol="words", pattern=r"[^\p{L}\p{N}]+"),
        HashingTF(inputCol="words", outputCol="counts", numFeatures=dimensions),
        IDF(inputCol="counts", outputCol="weighted"),
        Normalizer(inputCol="weighted", outputCol="unit", p=2.0),
    ]
    model = Pipeline(stages=steps).fit(texts)
    return model.transform(texts).select(
        "pubmed_id", vector_to_array("unit", "float32").alias("embedding")
    )


def project(embeddings: DataFrame) -> DataFrame:
    """M2, first half: (pubmed_id, x, y), the two main axes of ``embedding``.

    The driver solves a matrix of dimensions^2 numbers. Each axis points where
    its largest loading is positive, so that the sign is settled.
    """
    vectors = embeddings.select(
        "pubmed_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("vector")
    )
    model = PCA(k=2, inputCol="vector", outputCol="axes").fit(vectors)
    signs = [1.0 if max(axis, key=abs) > 0 else -1.0 for axis in model.pc.toArray().T]
    axes = model.transform(vectors).select("pubmed_id", vector_to_array("axes").alias("axes"))
    return axes.select(
        "pubmed_id",
        (F.col("axes")[0] * signs[0]).alias("x"),
        (F.col("axes")[1] * signs[1]).alias("y"),
    )


def cluster_embeddings(
    embeddings: DataFrame, radius: float, min_points: int = 10, min_cluster_size: int = 10
) -> DataFrame:
    """M2: (pubmed_id, x, y, cluster) of the projected embeddings."""
    return density_clusters(project(embeddings), radius, min_points, min_cluster_size)


def density_tree(
    points: DataFrame, k: int = 30, min_points: int = 10, min_cluster_size: int = 10
) -> DataFrame:
    """M2, second half: (pubmed_id, x, y, cluster), clusters of (pubmed_id, x, y) that may differ
    in density, from the hierarchy over the ``k`` nearest neighbours; -1 is noise."""
    vectors = points.select(F.col("pubmed_id").alias("id"), F.array("x", "y").alias("vector"))
    graph = neighbours.neighbour_graph(vectors, k=k)
    clusters = density.density_tree_clusters(graph, min_points, min_cluster_size)
    found = points.select("pubmed_id", "x", "y").join(clusters.withColumnRenamed("id", "pubmed_id"), "pubmed_id", "left")
    return found.withColumn("cluster", F.coalesce("cluster", F.lit(NOISE).cast("bigint")))


def map_embeddings(
    embeddings: DataFrame, k: int = 30, min_points: int = 10, min_cluster_size: int = 10
) -> DataFrame:
    """M2: (pubmed_id, x, y, cluster) of (pubmed_id, embedding): a layout in which neighbours are
    side by side, and its clusters of whatever density."""
    vectors = embeddings.select(F.col("pubmed_id").alias("id"), F.col("embedding").alias("vector"))
    graph = neighbours.neighbour_graph(vectors, k=k)
    layout = cut_lineage(neighbours.spectral_layout(graph).withColumnRenamed("id", "pubmed_id"))
    return density_tree(layout, k, min_points, min_cluster_size)


def density_clusters(
    points: DataFrame, radius: float, min_points: int = 10, min_cluster_size: int = 10
) -> DataFrame:
    """M2, second half: clusters of dense neighbourhoods of (pubmed_id, x, y).

    The plane is cut into cells of side ``radius``; cells that touch are
    neighbours. A cell is core when it and its neighbours hold ``min_points``
    points; neighbouring core cells belong together, other neighbours of a core
    cell join the cluster with the smallest cell next to them. Points outside, and
    clusters under ``min_cluster_size`` points, are noise (-1). Clusters are
    numbered from 0 in the order of their smallest core cell.

    Points are counted per cell at once and never paired, so a cell that holds
    most of them costs one partial count. All further steps are on cells.
    """
    across, up = F.floor(F.col("x") / radius), F.floor(F.col("y") / radius)
    placed = points.select(
        "pubmed_id", "x", "y", F.struct(across.alias("across"), up.alias("up")).alias("cell")
    )
    cells = cut_lineage(placed.groupBy("cell").agg(F.count("*").alias("points")))

    near = (
        cells.select(F.explode(_block("cell")).alias("cell"), "points")
        .groupBy("cell")
        .agg(F.sum("points").alias("near"))
    )
    core = cells.join(near, "cell").where(F.col("near") >= min_points).select("cell")
    core = cut_lineage(core)
    edges = (
        core.select(F.col("cell").alias("a"), F.explode(_block("cell")).alias("cell"))
        .join(core, "cell")
        .select("a", F.col("cell").alias("b"))
        .where(F.col("a") != F.col("b"))
    )
    labels = connected_components(core.select(F.col("cell").alias("id")), edges)
    # a core cell is in its own block: its own cluster number is the only one there
    own = labels.select(F.col("id").alias("cell"), "label", F.lit(True).alias("own"))
    reach = (
        labels.select(F.explode(_block("id")).alias("cell"), "label")
        .withColumn("own", F.lit(False))
        .unionByName(own)
        .groupBy("cell")
        .agg(F.coalesce(F.min(F.when(F.col("own"), F.col("label"))), F.min("label")).alias("label"))
    )
    labelled = cells.join(reach, "cell")
    large = (
        labelled.groupBy("label")
        .agg(F.sum("points").alias("size"))
        .where(F.col("size") >= min_cluster_size)
    )
    # one row per cluster reaches this window
    number = (F.row_number().over(W.orderBy("label")) - 1).cast("bigint")
    kept = labelled.join(large.select("label", number.alias("cluster")), "label").select(
        "cell", "cluster"
    )
    return placed.join(kept, "cell", "left").select(
        "pubmed_id", "x", "y", F.coalesce("cluster", F.lit(NOISE).cast("bigint")).alias("cluster")
    )


def _block(cell: str) -> Column:
    """A cell and the eight around it."""
    across, up = F.col(cell)["across"], F.col(cell)["up"]
    return F.array(
        *[
            F.struct((across + a).alias("across"), (up + b).alias("up"))
            for a in (-1, 0, 1)
            for b in (-1, 0, 1)
        ]
    )


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, label) with the smallest id of each component of ``edges(a, b)``.

    ``edges`` hold both directions. A round takes the smallest label among the
    neighbours and then the label of that label, so paths halve; it ends when
    no label changes. Only the number of changes reaches the driver.
    """
    edges = cut_lineage(edges)
    labels = nodes.select("id", F.col("id").alias("label"))
    while True:
        near = (
            edges.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("label").alias("near"))
        )
        hooked = labels.join(near, "id", "left").select(
            "id", F.col("label").alias("before"), F.least("label", "near").alias("label")
        )
        up = hooked.select(F.col("id").alias("label"), F.col("label").alias("up"))
        jumped = hooked.join(up, "label").select("id", "before", F.col("up").alias("label"))
        jumped = cut_lineage(jumped)
        labels = jumped.select("id", "label")
        if jumped.where(F.col("label") != F.col("before")).isEmpty():
            return labels
