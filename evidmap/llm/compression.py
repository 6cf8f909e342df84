"""Vector codes: product codebooks fitted by rounds of exact integer assignment, with pivots.

A vector becomes integers floor(``scale`` * x) and is cut into equal consecutive parts; each
part position has a codebook. The distance from every part to a few fixed pivots (entries of
the first codebook far from each other) is computed once and written beside the vector. In
each round the distances from the entries to the same pivots give a lower bound of every
distance, |d(part, pivot) - d(entry, pivot)|: entries are tried in the order of that bound,
and those whose bound is above the least distance found so far are never evaluated. What is
evaluated is exact, so the bounds change the work and not the result.

A round shuffles, per task, one row of sums for each entry used there; the codebooks, whose
size is a parameter, are the only thing the driver holds. No key is hot: vectors are not
shuffled until errors are summed by label, combined before the shuffle.

Edge cases: rows whose vector is null, holds null or non-finite components, or components of
2^27 / ``scale`` and more (their squared distances do not fit 64 bits) are dropped, as are those
of another length than the most frequent one that the number of parts divides (ties: the
longer one); very long vectors are vectors like others. Rows of equal id are rows of their own;
as first entries they come by id, then by vector; null ids come last and stay. Fewer kept
vectors than entries give smaller codebooks, an empty table no rows. Other columns, whatever
their names, play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidmap.llm.catalog import query
from evidmap.llm.tables import table, written

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
PIVOTS = 4
RANGE = 1 << 27  # integers stay below: 64 squared differences fit in 63 bits
SLACK = 1e-6  # relative; distances to pivots are kept with 24 bits


def whole_and_finite(vector: str, scale: int) -> Column:
    """Whether the vector is there and all components are numbers that the codes can hold."""
    fits = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < RANGE / scale))
    return F.coalesce(fits, F.lit(False))


def integers(vector: str, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).try_cast("int"))


def common_length(vectors: DataFrame, parts: int) -> int:
    """The most frequent length of ``v`` that ``parts`` divides; 0 without any."""
    lengths = vectors.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n"))
    best = lengths.where((F.col("size") > 0) & (F.col("size") % parts == 0))
    row = best.orderBy(F.desc("n"), F.desc("size")).first()
    return row.size if row else 0


def spread_out(entries: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` different rows far from each other: each is the farthest from those before."""
    chosen = [0]
    far = ((entries - entries[0]) ** 2).sum(1)
    while len(chosen) < n and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((entries - entries[chosen[-1]]) ** 2).sum(1))
    return entries[chosen + [0] * (n - len(chosen))]


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance from each row to each pivot."""
    return np.sqrt(np.stack([((rows - p) ** 2).sum(1) for p in pivots], axis=1).astype(np.float64))


def nearest(
    rows: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, entry_to_pivots: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry of each row (ties: the lower one), its squared distance, and how many
    distances were evaluated."""
    bound = np.zeros((len(rows), len(entries)))
    for own, other in zip(to_pivots.T, entry_to_pivots.T):
        apart = np.abs(own[:, None] - other[None, :]) - SLACK * (own[:, None] + other[None, :])
        np.maximum(bound, apart, out=bound)
    bound *= bound
    order = np.argsort(bound, axis=1, kind="stable")
    found = np.zeros(len(rows), np.int64)
    least = np.full(len(rows), np.iinfo(np.int64).max)
    open_, evaluated = np.arange(len(rows)), 0
    for rank in range(len(entries)):
        entry = order[open_, rank]
        # an equal bound may still be a tie
        may = bound[open_, entry] <= least[open_]
        open_, entry = open_[may], entry[may]
        if not len(open_):
            break
        evaluated += len(open_)
        exact = ((rows[open_] - entries[entry]) ** 2).sum(1)
        better = (exact < least[open_]) | ((exact == least[open_]) & (entry < found[open_]))
        at = open_[better]
        found[at], least[at] = entry[better], exact[better]
    return found, least, evaluated


class Codebooks:
    """Entries (parts x entries x components) with the distances to the fixed pivots."""

    def __init__(self, entries: np.ndarray, pivots: np.ndarray) -> None:
        self.entries, self.pivots = entries, pivots
        self.to_pivots = [distances(e, p) for e, p in zip(entries, pivots)]

    def assign(self, vectors: np.ndarray, to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of every part of every vector."""
        n, parts, _ = vectors.shape
        codes, errors = np.zeros((n, parts), np.int64), np.zeros((n, parts), np.int64)
        for p in range(parts):
            codes[:, p], errors[:, p], _ = nearest(
                vectors[:, p], to_pivots[:, p], self.entries[p], self.to_pivots[p]
            )
        return codes, errors


def _matrix(column: pa.Array, *shape: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), *shape)


def _with_pivots(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``vectors`` with ``far``: distances of every part to its pivots."""
    parts, n_pivots, width = pivots.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column("v"), parts, width).astype(np.int64)
            far = np.stack([distances(rows[:, p], pivots[p]) for p in range(parts)], axis=1)
            flat = pa.array(far.astype(np.float32).ravel())
            ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * parts * n_pivots)
            lists = pa.ListArray.from_arrays(ends, flat)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "far"])

    schema = T.StructType([*vectors.schema.fields, *T.StructType.fromDDL("far array<float>")])
    return vectors.mapInArrow(run, schema)


def _rows(batch: pa.RecordBatch, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    parts, n_pivots, width = books.pivots.shape
    vectors = _matrix(batch.column("v"), parts, width).astype(np.int64)
    return vectors, _matrix(batch.column("far"), parts, n_pivots).astype(np.float64)


def _next_entries(vectors: DataFrame, books: Codebooks) -> np.ndarray:
    """Mean of the parts of each entry, rounded down; entries without parts stay."""
    parts, size, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts * size, width), np.int64)
        counts = np.zeros(parts * size, np.int64)
        for batch in batches:
            rows, far = _rows(batch, books)
            codes, _ = books.assign(rows, far)
            at = (codes + np.arange(parts) * size).ravel()
            counts += np.bincount(at, minlength=len(counts))
            np.add.at(sums, at, rows.reshape(-1, width))
        used = np.flatnonzero(counts)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), pa.array(counts[used]), pa.array(list(sums[used]), pa.list_(pa.int64()))],
                ["at", "n", "sums"],
            )

    partial = vectors.select("v", "far").mapInArrow(run, "at bigint, n bigint, sums array<bigint>")
    totals = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    entries = books.entries.copy()
    # as many rows as the codebooks have entries
    for row in partial.groupBy("at").agg(F.sum("n").alias("n"), *totals).collect():
        entries[row.at // size, row.at % size] = [int(row[f"s{i}"]) // row.n for i in range(width)]
    return entries


def vector_codes(
    rows: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    pivots: int = PIVOTS,
) -> tuple[DataFrame, np.ndarray]:
    """(id, label, codes array<int>, error bigint) per kept row, and the codebooks
    (parts x entries x components)."""
    kept = rows.where(whole_and_finite(vector, scale)).select(
        F.col(vec_id).alias("id"), F.col(label).alias("label"), integers(vector, scale).alias("v")
    )
    schema = T.StructType(
        [*kept.schema.fields[:2], *T.StructType.fromDDL("codes array<int>, error bigint")]
    )
    length = common_length(kept, parts)
    if not length:
        return rows.sparkSession.createDataFrame([], schema), np.zeros((parts, 0, 0), np.int64)
    width = length // parts
    kept = kept.where(F.size("v") == length)
    first = kept.orderBy(F.asc_nulls_last("id"), "v").limit(entries).select("v").collect()
    start = np.array([r.v for r in first], np.int64).reshape(len(first), parts, width)
    start = start.transpose(1, 0, 2).copy()
    fixed = np.stack([spread_out(book, pivots) for book in start])
    vectors = written(_with_pivots(kept, fixed), "vectors")
    books = Codebooks(start, fixed)
    for _ in range(rounds):
        books = Codebooks(_next_entries(vectors, books), fixed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = books.assign(*_rows(batch, books))
            ends = pa.array(np.arange(len(codes) + 1, dtype=np.int32) * parts)
            lists = pa.ListArray.from_arrays(ends, pa.array(codes.astype(np.int32).ravel()))
            columns = [batch.column("id"), batch.column("label"), lists, pa.array(errors.sum(1))]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return vectors.mapInArrow(run, schema), books.entries


_OLD = ", ".join(f"v[{i}]" for i in range(1, 5))
_MEAN = ", ".join(
    f"CAST((sum(q.v[{i}]) - ((sum(q.v[{i}]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT)"
    for i in range(1, 5)
)
_APART = " + ".join(f"(q.v[{i}] - b.v[{i}]) * (q.v[{i}] - b.v[{i}])" for i in range(1, 5))


def _near(n: int) -> str:
    return f"""near{n} AS (
  SELECT q.vec_id, q.p, min(({_APART}) * 64 + b.entry) AS best
  FROM cut q JOIN book{n} b ON q.p = b.p GROUP BY q.vec_id, q.p)"""


def _book(n: int) -> str:
    return f"""mean{n} AS (
  SELECT q.p, near{n - 1}.best % 64 AS entry, [{_MEAN}] AS v
  FROM cut q JOIN near{n - 1} ON q.vec_id = near{n - 1}.vec_id AND q.p = near{n - 1}.p
  GROUP BY q.p, near{n - 1}.best % 64),
book{n} AS (
  SELECT b.p, b.entry, coalesce(m.v, b.v) AS v
  FROM book{n - 1} b LEFT JOIN mean{n} m ON b.p = m.p AND b.entry = m.entry)"""


_SQL = f"""WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS (SELECT vec_id, label, CAST(p AS BIGINT) AS p, v[4 * p + 1:4 * p + 4] AS v FROM kept, range(16) t(p)),
book0 AS (
  SELECT CAST(p AS BIGINT) AS p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS entry,
    v[4 * p + 1:4 * p + 4] AS v
  FROM (SELECT * FROM kept ORDER BY vec_id LIMIT 64), range(16) t(p)),
{_near(0)},
{_book(1)},
{_near(1)},
{_book(2)},
{_near(2)},
coded AS (
  SELECT vec_id, string_agg(printf('%02x', best % 64), '' ORDER BY p) AS code,
    CAST(sum(best // 64) AS BIGINT) AS error
  FROM near2 GROUP BY vec_id)
SELECT vec_id, code, error,
  CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, entry, i))
   FROM (SELECT p, entry, unnest([{_OLD}]) AS x, unnest([1, 2, 3, 4]) AS i FROM book2)) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)"""


@query("op11_vector_codes", _SQL)
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes(table(spark, sf_dir, "embeddings"))
    numbers = ",".join(map(str, books.ravel().tolist()))
    digest = hashlib.sha256(numbers.encode()).hexdigest()
    coded = written(coded, "codes")
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error"))
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias("vec_id"),
        code.alias("code"),
        "error",
        "label_error",
        F.lit(digest).alias("codebooks_sha256"),
    )
