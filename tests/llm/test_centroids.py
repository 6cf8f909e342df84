from __future__ import annotations

import hashlib
import math
import random

import numpy as np

from evidmap.llm import centroids as c

SCHEMA = "vec_id bigint, embedding array<float>, cluster int, id string, v int, distance string"


def plain(rows, k, rounds, scale, size):
    kept = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    chance = lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest()
    kept.sort(key=lambda r: (r[0] is None, chance(r[0]), r[1]))
    centres = [v for _, v in kept[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m)), n) for n, m in enumerate(centres))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for n in range(len(centres)):
            mine = [v for (_, v), m in zip(kept, own) if m == n]
            if mine:
                centres[n] = [sum(x) // len(mine) for x in zip(*mine)]
    return [(i, near(v)[1], near(v)[0]) for i, v in kept], centres


def vectors(n, size, seed):
    rng = random.Random(seed)
    return [(i, [float(np.float32(round(rng.gauss(0, 0.3), 1))) for _ in range(size)]) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], SCHEMA).repartition(3)


def test_like_plain_loops(spark):
    rows = vectors(120, 6, 1)
    rows += [(5, rows[5][1]), (5, rows[6][1]), (None, rows[8][1])]
    odd = [(800, None), (801, [1.0] * 5), (802, [float("nan")] * 6), (803, [None] * 6), (804, [math.inf] * 6), (805, [])]
    odd += [(806, [3e30] * 6)]
    got, centres = c.centroid_clusters(frame(spark, rows + odd), centroids=7, dimensions=6)
    want, plain_centres = plain(rows, 7, c.ROUNDS, c.SCALE, 6)
    assert centres.tolist() == plain_centres
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_tables_hold_occurring_numbers_only():
    vectors_ = np.array([[1, 1000], [1, -5], [3, -5]])
    tables = c.Tables(vectors_, np.array([[0, 0], [3, -5]]))
    assert len(tables.squares) == 4  # 1 and 3; -5 and 1000
    found, distance = tables.nearest()
    assert found.tolist() == [0, 1, 1] and distance.tolist() == [1000001, 4, 0]


def test_few_vectors_and_empty(spark):
    got, centres = c.centroid_clusters(frame(spark, vectors(3, 6, 2)), centroids=7, dimensions=6)
    assert sorted(r.cluster for r in got.collect()) == [0, 1, 2] and len(centres) == 3
    got, centres = c.centroid_clusters(spark.createDataFrame([], SCHEMA))
    assert got.columns == ["id", "cluster", "distance"] and got.collect() == [] and not len(centres)


def test_query_columns(spark, tmp_path):
    rows = vectors(60, 64, 4) + [(70, None), (71, [0.5] * 63)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").write.parquet(
        str(tmp_path / "embeddings.parquet")
    )
    want, centres = plain(rows, 16, 3, 64, 64)
    got = {r.vec_id: r for r in c.op12_centroid_clusters(spark, str(tmp_path)).collect()}
    assert len(got) == len(want) == 60
    for i, cluster, distance in want:
        row = got[i]
        assert (row.cluster, row.distance) == (cluster, distance)
        assert row.cluster_inertia == sum(d for _, k, d in want if k == cluster)
        assert row.inertia == sum(d for _, _, d in want)
        numbers = ",".join(map(str, centres[cluster]))
        assert row.centroid_sha256 == hashlib.sha256(numbers.encode()).hexdigest()
