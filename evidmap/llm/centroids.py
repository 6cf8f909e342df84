"""Centroid clusters by scalar lookup tables, in whole numbers.

Vectors become integers floor(``scale`` * x). The integers that occur in a batch are few for
each dimension: a round tabulates, for every dimension, occurring integer and centroid, the
squared difference once, and the distance of a vector is the sum of table rows gathered by its
integers. All sums are exact, so neither order nor partitioning changes a result.

A round shuffles, per task, one row of sums for each centroid used there; the driver holds the
centroids, whose number and length are parameters. Vectors are never shuffled; the inertia is
summed before the shuffle, so a cluster may hold most vectors.

Edge cases: vectors that are null, have another number of components than ``dimensions``, or
hold null or non-finite components, or components of 2^27 / ``scale`` and more (their squared
distances do not fit 64 bits), are dropped. Rows of equal id are rows of their own; as first
centroids they come by the hash of the id, then by vector; null ids have no hash, come last and
stay. Fewer kept vectors than centroids give fewer centroids, an empty table no rows. Very long
vectors are of another length and go. Other columns, whatever their names, play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidmap.llm.catalog import query
from evidmap.llm.compression import integers, whole_and_finite
from evidmap.llm.tables import table, written

SCALE = 64
DIMENSIONS = 64
CENTROIDS = 16
ROUNDS = 3
SEED = 1


class Tables:
    """Squared differences for each dimension, occurring integer and centroid."""

    def __init__(self, vectors: np.ndarray, centroids: np.ndarray) -> None:
        self.codes, tables, size = np.empty(vectors.shape, np.int64), [], 0
        for d in range(vectors.shape[1]):
            values, codes = np.unique(vectors[:, d], return_inverse=True)
            # all tables stand in one array, each from its own place on
            self.codes[:, d] = codes + size
            tables.append((values[:, None] - centroids[None, :, d]) ** 2)
            size += len(values)
        self.squares = np.concatenate(tables)

    def nearest(self) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid of every vector (ties: the smaller number) and its squared distance."""
        sums = np.zeros((len(self.codes), self.squares.shape[1]), np.int64)
        for column in self.codes.T:
            sums += self.squares[column]
        found = sums.argmin(1)
        return found, sums[np.arange(len(found)), found]


def _vectors(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, dimensions).astype(np.int64)


def _next_centroids(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Mean of the vectors of each centroid, rounded down; empty ones stay."""
    size, dimensions = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(centroids.shape, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            own = _vectors(batch, dimensions)
            found, _ = Tables(own, centroids).nearest()
            counts += np.bincount(found, minlength=size)
            np.add.at(sums, found, own)
        used = np.flatnonzero(counts)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), pa.array(counts[used]), pa.array(list(sums[used]), pa.list_(pa.int64()))],
                ["cluster", "n", "sums"],
            )

    partial = vectors.select("v").mapInArrow(run, "cluster bigint, n bigint, sums array<bigint>")
    totals = [F.sum(F.col("sums")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(dimensions)]
    moved = centroids.copy()
    # one row for each centroid
    for row in partial.groupBy("cluster").agg(F.sum("n").alias("n"), *totals).collect():
        moved[row.cluster] = [int(row[f"s{d}"]) // row.n for d in range(dimensions)]
    return moved


def centroid_clusters(
    rows: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    dimensions: int = DIMENSIONS,
    seed: int = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster int, distance bigint) per kept row, and the final centroids.

    The first centroids are the vectors whose ``<seed>:<id>`` has the least SHA-256.
    """
    whole = whole_and_finite(vector, scale) & (F.size(vector) == dimensions)
    kept = rows.where(whole).select(F.col(vec_id).alias("id"), integers(vector, scale).alias("v"))
    vectors = written(kept, "whole-vectors")
    chance = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = vectors.orderBy(F.asc_nulls_last(chance), "v").limit(centroids).select("v").collect()
    schema = T.StructType(
        [kept.schema["id"], *T.StructType.fromDDL("cluster int, distance bigint")]
    )
    now = np.array([r.v for r in first], np.int64).reshape(len(first), dimensions)
    if not len(now):
        return rows.sparkSession.createDataFrame([], schema), now
    for _ in range(rounds):
        now = _next_centroids(vectors, now)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, distance = Tables(_vectors(batch, dimensions), now).nearest()
            columns = [batch.column("id"), pa.array(found.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return vectors.mapInArrow(run, schema), now


_APART = "list_sum(list_transform(list_zip(q.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"


def _near(n: int) -> str:
    return f"""near{n} AS (
  SELECT q.vec_id, min(CAST({_APART} AS BIGINT) * 16 + c.cluster) AS best
  FROM kept q, centre{n} c GROUP BY q.vec_id)"""


def _centre(n: int) -> str:
    return f"""mean{n} AS (
  SELECT cluster, list(m ORDER BY i) AS v FROM (
    SELECT cluster, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
    FROM (SELECT best % 16 AS cluster, unnest(v) AS x, unnest(range(64)) AS i
          FROM kept JOIN near{n - 1} USING (vec_id))
    GROUP BY cluster, i)
  GROUP BY cluster),
centre{n} AS (
  SELECT c.cluster, coalesce(m.v, c.v) AS v FROM centre{n - 1} c LEFT JOIN mean{n} m USING (cluster))"""


_SQL = f"""WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
centre0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster, v
  FROM (SELECT * FROM kept ORDER BY sha256('1:' || vec_id) LIMIT 16)),
{_near(0)},
{_centre(1)},
{_near(1)},
{_centre(2)},
{_near(2)},
{_centre(3)},
{_near(3)}
SELECT vec_id, CAST(best % 16 AS INTEGER) AS cluster, best // 16 AS distance,
  CAST(sum(best // 16) OVER (PARTITION BY best % 16) AS BIGINT) AS cluster_inertia,
  CAST(sum(best // 16) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM near3 JOIN centre3 c ON c.cluster = best % 16"""


@query("op12_centroid_clusters", _SQL)
def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = centroid_clusters(table(spark, sf_dir, "embeddings"))
    found = written(found, "clusters")
    # one row for each centroid
    sums = {r.cluster: r.s for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digests = [
        (k, s, sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[k].tolist())).encode()).hexdigest())
        for k, s in sums.items()
    ]
    of_cluster = spark.createDataFrame(
        digests, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    return found.join(F.broadcast(of_cluster), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
