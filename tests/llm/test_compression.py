from __future__ import annotations

import math
import random

import numpy as np
import pytest

from evidmap.llm import compression as c

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, codes int, v string, far int"


def plain(rows, parts, entries, rounds, scale):
    """Codes, errors and codebooks by loops over whole numbers."""
    kept = [
        (i, label, [math.floor(scale * x) for x in v])
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = len(kept[0][2]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, _, v in kept[:entries]] for p in range(parts)]

    def near(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        members = [[[] for _ in book] for book in books]
        for _, _, v in kept:
            for p in range(parts):
                members[p][near(p, cut(v, p))[1]].append(cut(v, p))
        for p in range(parts):
            for k, own in enumerate(members[p]):
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own)]
    found = []
    for i, label, v in kept:
        best = [near(p, cut(v, p)) for p in range(parts)]
        found.append((i, label, [k for _, k in best], sum(d for d, _ in best)))
    return found, books


def vectors(n, size, seed, spread=0.4):
    rng = random.Random(seed)
    # few different values: many equal distances
    return [
        (i, [float(np.float32(round(rng.gauss(0, spread), 1))) for _ in range(size)], rng.choice([None, 1, 2]))
        for i in range(n)
    ]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize(("parts", "entries", "pivots"), [(4, 8, 3), (16, 64, 4), (2, 5, 1)])
def test_like_plain_loops(spark, parts, entries, pivots):
    rows = vectors(150, 16 if parts != 16 else 64, parts)
    rows += [(7, rows[7][1], 1), (7, rows[9][1], 2), (None, rows[3][1], 1)]
    odd = [(900, None, 1), (901, [float("nan")] * len(rows[0][1]), 1), (902, [float("-inf")] * len(rows[0][1]), 1)]
    odd += [(903, [None] * len(rows[0][1]), 2)]
    got, books = c.vector_codes(frame(spark, rows + odd), parts=parts, entries=entries, pivots=pivots)
    want, plain_books = plain(rows, parts, entries, c.ROUNDS, c.SCALE)
    assert books.tolist() == plain_books
    key = lambda r: repr(tuple(r))
    assert sorted(map(key, got.collect())) == sorted(map(key, want))


def test_pivots_save_work_and_change_nothing():
    rng = np.random.default_rng(3)
    entries = rng.integers(-300, 300, (64, 4))
    rows = entries[rng.integers(0, 64, 4000)] + rng.integers(-20, 20, (4000, 4))
    pivots = c.spread_out(entries, 4)
    far = c.distances(rows, pivots).astype(np.float32).astype(np.float64)
    found, least, evaluated = c.nearest(rows, far, entries, c.distances(entries, pivots))
    every = ((rows[:, None] - entries[None]) ** 2).sum(2)
    assert np.array_equal(found, every.argmin(1)) and np.array_equal(least, every.min(1))
    assert evaluated < 0.2 * every.size


def test_ties_go_to_the_lower_entry():
    entries = np.array([[5, 0], [-5, 0], [5, 0], [0, 5]])
    rows = np.array([[0, 0], [5, 0], [0, 1]])
    pivots = c.spread_out(entries, 2)
    found, least, _ = c.nearest(rows, c.distances(rows, pivots), entries, c.distances(entries, pivots))
    assert found.tolist() == [0, 0, 3] and least.tolist() == [25, 0, 16]


def test_other_lengths_and_large_numbers_go(spark):
    rows = vectors(20, 8, 5) + [(50, [1.0] * 4, 1), (51, [], 1), (52, [1.0] * 7, 1), (53, [1e30] * 8, 1)]
    got, _ = c.vector_codes(frame(spark, rows), parts=4, entries=4)
    assert sorted(r.id for r in got.collect()) == list(range(20))


def test_empty(spark):
    got, books = c.vector_codes(spark.createDataFrame([], SCHEMA))
    assert got.columns == ["id", "label", "codes", "error"] and got.collect() == [] and books.size == 0


def test_query_columns(spark, tmp_path):
    rows = vectors(80, 64, 9) + [(500, None, 1)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(
        str(tmp_path / "embeddings.parquet")
    )
    want, books = plain(rows, 16, 64, 2, 256)
    got = {r.vec_id: r for r in c.op11_vector_codes(spark, str(tmp_path)).collect()}
    assert set(got) == {i for i, _, _, _ in want}
    for i, label, codes, error in want:
        row = got[i]
        assert row.code == "".join(f"{k:02x}" for k in codes) and row.error == error
        assert row.label_error == sum(e for _, other, _, e in want if other == label)
    import hashlib

    numbers = ",".join(str(x) for book in books for e in book for x in e)
    assert {r.codebooks_sha256 for r in got.values()} == {hashlib.sha256(numbers.encode()).hexdigest()}
