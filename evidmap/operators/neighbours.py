"""A graph of nearest neighbours over vectors, and a layout in the plane from it (M2).

*Graph.* Rows are sorted by the sides of a few random planes and a random projection; each stretch
of ``block`` rows in that order is compared whole. Several such orders, none of which knows a
hot bucket because stretches have a length and not a key, give first lists. Rounds of exchange
then improve them: what is near to the same vector is compared, and a pair travels on only where
it is better than the worst neighbour known.

*Layout.* The two directions in which neighbours differ least (the eigenvectors after the trivial one
of the symmetric graph), by power iteration: a round is a join of the links with the positions and a
sum by row; the driver sees the 2 x 2 products of the directions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidmap.runtime import stored

BLOCK = 1024
ROWS_A_TASK = 16 * BLOCK


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances by differences: equal vectors have exactly 0."""
    found = np.empty((len(a), len(b)))
    step = max(1, (1 << 22) // max(1, b.size))
    for at in range(0, len(a), step):
        found[at : at + step] = ((a[at : at + step, None] - b[None]) ** 2).sum(2)
    return found


def _pairs(ids: pa.Array, rows: np.ndarray, other: np.ndarray, distance: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(rows)), pa.array(distance), ids.take(pa.array(other))], ["id", "distance", "other"]
    )


def _within(ids: pa.Array, vectors: np.ndarray, k: int) -> pa.RecordBatch:
    """The ``k`` nearest of each row among the others, all compared."""
    far = _squared(vectors, vectors)
    np.fill_diagonal(far, np.inf)
    k = min(k, len(far) - 1)
    # equal distances are taken in the order of the rows, which is by id
    near = np.argsort(far, axis=1, kind="stable")[:, :k]
    rows = np.repeat(np.arange(len(far)), k)
    return _pairs(ids, rows, near.ravel(), np.sqrt(far[rows, near.ravel()]))


def _pair_schema(vectors: DataFrame) -> T.StructType:
    own = vectors.schema["id"].dataType
    return T.StructType(
        [T.StructField("id", own), T.StructField("distance", T.DoubleType()), T.StructField("other", own)]
    )


def _in_blocks(vectors: DataFrame, n: int, length: int, k: int, block: int, seed: int) -> DataFrame:
    """Pairs near to each other in one random order of the vectors."""
    rng = np.random.default_rng(seed)
    planes = max(0, math.ceil(math.log2(max(1, n / block))))
    normals = rng.normal(size=(planes + 1, length))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            along = _matrix(batch.column("vector")).reshape(batch.num_rows, length) @ normals.T
            side = ((along[:, :planes] > 0) << np.arange(planes)).sum(1).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(side), pa.array(along[:, planes])], [*batch.schema.names, "side", "along"]
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            rows = pa.Table.from_batches(held)
            # the last stretch is up to twice as long, so that none is short
            while len(rows) >= 2 * block:
                yield compared(rows.slice(0, block))
                rows = rows.slice(block)
            held = rows.to_batches()
        if held:
            yield compared(pa.Table.from_batches(held))

    def compared(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.sort_by("id").combine_chunks()
        return _within(rows.column("id").combine_chunks(), _matrix(rows.column("vector").combine_chunks()), k)

    schema = T.StructType([*vectors.schema.fields, *T.StructType.fromDDL("side bigint, along double")])
    order = ("side", "along", "id")
    placed = vectors.mapInArrow(place, schema)
    dealt = placed.repartitionByRange(math.ceil(n / ROWS_A_TASK), *order).sortWithinPartitions(*order)
    return dealt.mapInArrow(compare, _pair_schema(vectors))


def _best(pairs: DataFrame, k: int) -> DataFrame:
    """(id, neighbours): the ``k`` nearest of each row of (id, distance, other), by distance."""
    found = F.collect_set(F.struct("distance", "other")).alias("found")
    return pairs.groupBy("id").agg(found).select("id", F.slice(F.array_sort("found"), 1, k).alias("neighbours"))


def _exchanged(vectors: DataFrame, graph: DataFrame, k: int) -> DataFrame:
    """Pairs that have a neighbour in common and are better than what both, or one, know."""
    # one row for each vector and neighbour: as many as the graph has links
    worst = graph.select(F.col("id").alias("other"), F.get("neighbours", F.lit(k - 1))["distance"].alias("worst"))
    known = vectors.withColumnRenamed("id", "other").join(worst, "other", "left")
    links = graph.select("id", F.explode("neighbours.other").alias("other"))
    links = links.unionByName(graph.select("id", F.col("id").alias("other")))
    around = links.join(known, "other").select("id", "other", "vector", F.coalesce("worst", F.lit(math.inf)).alias("worst"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            ids, vectors_ = group.column("other").combine_chunks(), _matrix(group.column("vector").combine_chunks())
            far = np.sqrt(_squared(vectors_, vectors_))
            np.fill_diagonal(far, np.inf)
            rows, other = np.nonzero(far < group.column("worst").to_numpy()[:, None])
            yield _pairs(ids, rows, other, far[rows, other])

    dealt = around.repartition("id").sortWithinPartitions("id", "other")
    pairs = dealt.mapInArrow(compare, _pair_schema(vectors))
    # the best of each task first, so that a vector near to many others is folded before the shuffle
    return pairs.mapInArrow(_folded(k), _pair_schema(vectors))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each id, one after the other; at most k + 1 of them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        ids = batch.column("id").to_pylist()
        cuts = [0, *(i for i in range(1, len(ids)) if ids[i] != ids[i - 1]), len(ids)]
        for start, end in zip(cuts, cuts[1:]):
            if start == end:
                continue
            if held and held[-1].column("id")[0].as_py() != ids[start]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def _folded(k: int, most: int = 200_000):
    def best(rows: pa.Table) -> pa.Table:
        rows = rows.group_by(["id", "other"]).aggregate([("distance", "min")])
        rows = rows.select(["id", "distance_min", "other"]).rename_columns(["id", "distance", "other"])
        rows = rows.sort_by([("id", "ascending"), ("distance", "ascending"), ("other", "ascending")])
        codes = rows.column("id").combine_chunks().dictionary_encode().indices.to_numpy()
        first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else codes
        rank = np.arange(len(codes)) - np.repeat(first, np.diff(np.append(first, len(codes))))
        return rows.filter(pa.array(rank < k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size > most:
                held = best(pa.Table.from_batches(held)).to_batches()
                size = sum(b.num_rows for b in held)
                if size > most / 2:
                    yield from held
                    held, size = [], 0
        if size:
            yield from best(pa.Table.from_batches(held)).to_batches()

    return run


def neighbour_graph(
    vectors: DataFrame, k: int = 15, orders: int = 4, rounds: int = 3, block: int = BLOCK, seed: int = 42
) -> DataFrame:
    """(id, neighbours array<struct<distance, other>>) of (id, vector): nearest first, ties by id.

    Up to ``2 * block`` vectors are all compared, so their lists are exact. Rows whose vector is
    null or holds null or non-finite components, or has another length than the vector of the
    least id, are left out; ids are distinct.
    """
    if k >= block:
        raise ValueError("a block has more vectors than a list of neighbours")
    vector = F.transform("vector", lambda x: x.cast("double"))
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf)))
    vectors = vectors.where(F.col("id").isNotNull()).select("id", vector.alias("vector")).where(finite)
    vectors = stored(vectors)
    first = vectors.orderBy("id").select(F.size("vector").alias("size")).first()
    length = first.size if first else 0
    vectors = vectors.where(F.size("vector") == length)
    n = vectors.count()
    if n < 2:
        pair = "array<struct<distance:double,other:{}>>".format(vectors.schema["id"].dataType.simpleString())
        return vectors.select("id", F.array().cast(pair).alias("neighbours"))
    exact = n < 2 * block
    pairs = _in_blocks(vectors, n, length, k, block, seed)
    for order in range(1, 1 if exact else orders):
        pairs = pairs.unionByName(_in_blocks(vectors, n, length, k, block, seed + order))
    graph = stored(_best(pairs, k))
    for _ in range(0 if exact else rounds):
        listed = graph.select("id", F.inline("neighbours").alias("distance", "other"))
        better = listed.unionByName(_exchanged(vectors, graph, k))
        graph = stored(_best(better, k))
    return graph


def spectral_layout(graph: DataFrame, iterations: int = 24, every: int = 4) -> DataFrame:
    """(id, x, y): where neighbours are side by side, from ``graph`` (id, neighbours).

    Links count both ways, each with weight 1. ``every`` so many iterations the two directions are
    made independent of each other and of the trivial one. Each axis has length 1 and points where
    its largest coordinate (ties: of the least id) is positive.
    """
    links = graph.select("id", F.explode("neighbours.other").alias("other"))
    links = links.unionByName(links.select(F.col("other").alias("id"), F.col("id").alias("other"))).distinct()
    degrees = links.groupBy("id").agg(F.count("*").cast("double").alias("degree"))
    # the trivial direction of the scaled graph is the root of the degree
    base = graph.select("id").join(degrees, "id", "left").select("id", F.sqrt(F.coalesce("degree", F.lit(0.0))).alias("root"))
    base = stored(base)
    ends = base.select(F.col("id").alias("other"), F.col("root").alias("other_root"))
    # halfway to the mean of the neighbours, so that no direction swings to and fro: a link of each
    # row to itself, so that a round reads the positions once
    weight = F.lit(0.5) / F.col("root") / F.col("other_root")
    links = links.join(base, "id").join(ends, "other").select("id", "other", weight.alias("w"))
    links = stored(links.unionByName(base.select("id", F.col("id").alias("other"), F.lit(0.5).alias("w"))), "links")

    def chance(number: int):
        return F.xxhash64(F.lit(number), F.col("id").cast("string")).cast("double") / F.lit(2.0**63)

    at = _independent(base.select("id", chance(1).alias("x"), chance(2).alias("y")), base)
    for done in range(1, iterations + 1):
        met = links.join(at.select(F.col("id").alias("other"), "x", "y"), "other")
        at = met.groupBy("id").agg(*[F.sum(F.col("w") * F.col(c)).alias(c) for c in ("x", "y")])
        if done % every == 0 or done == iterations:
            at = _independent(at, base)
    at = at.join(base, "id")
    placed = at.select(
        "id",
        *[F.when(F.col("root") > 0, F.col(c) / F.col("root")).otherwise(F.lit(0.0)).alias(c) for c in ("x", "y")],
    )
    largest = placed.agg(*[F.max(F.struct(F.abs(c).alias("size"), c)).alias(c) for c in ("x", "y")]).first()
    signs = {c: -1.0 if largest[c] and largest[c][c] < 0 else 1.0 for c in ("x", "y")}
    return placed.select("id", *[(F.col(c) * signs[c]).alias(c) for c in ("x", "y")])


def _independent(at: DataFrame, base: DataFrame) -> DataFrame:
    """x and y at right angles to ``root`` of ``base`` and to each other, of length 1."""
    at = stored(at.join(base, "id"), "layout")

    def product(a: str, b: str):
        return F.sum(F.col(a) * F.col(b)).alias(f"{a}_{b}")

    s = at.agg(*[product(a, b) for a, b in (("root", "root"), ("root", "x"), ("root", "y"), ("x", "x"), ("x", "y"), ("y", "y"))]).first()
    rr = s.root_root or 1.0
    px, py = (s.root_x or 0.0) / rr, (s.root_y or 0.0) / rr
    xx = (s.x_x or 0.0) - px * px * rr
    xy = (s.x_y or 0.0) - px * py * rr
    yy = (s.y_y or 0.0) - py * py * rr
    along = xy / xx if xx > 0 else 0.0
    rest = yy - along * xy
    x, y = F.col("x") - F.col("root") * px, F.col("y") - F.col("root") * py
    x_size, y_size = math.sqrt(xx) if xx > 0 else 1.0, math.sqrt(rest) if rest > 0 else 1.0
    return at.select("id", (x / x_size).alias("x"), ((y - x * along) / y_size).alias("y"))
