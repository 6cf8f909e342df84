"""Links between 64-bit fingerprints that differ in few bits, by pigeonhole blocks.

The bits are cut into parts with thresholds that sum to ``max_bits`` - parts + 1: two
fingerprints within ``max_bits`` are within the threshold of some part, or they would
differ in more. A fingerprint is filed under its value of each part and under all values
within the part's threshold; what meets in a bucket is verified. A bucket of more than
``cell`` rows is filed anew by the bits its key leaves over, again cut by the
pigeonhole principle, so no bucket grows with the corpus. A bucket returns the least
fingerprint of each of its linked groups: as many links as rows, not as many as pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidmap.llm.buckets import map_groups
from evidmap.llm.tables import written

CELL = 2000
MIX = 0x9E3779B97F4A7C15


class Part(NamedTuple):
    bits: tuple[int, ...]  # places of its bits
    threshold: int  # bits in which partners may differ here; -1: not searched


def mask_of(bits: Sequence[int]) -> int:
    return sum(1 << b for b in bits)


def even_parts(max_bits: int) -> list[Part]:
    """The plain pigeonhole: one part more than bits may differ, all thresholds 0."""
    return [Part(tuple(int(b) for b in p), 0) for p in np.array_split(np.arange(64), max_bits + 1)]


def flips(part: Part) -> np.ndarray:
    """Masks that turn a value of the part into all values within its threshold."""
    masks = [
        mask_of(chosen)
        for n in range(part.threshold + 1)
        for chosen in combinations(part.bits, n)
    ]
    return np.array(masks, np.uint64)


def mixed(values: np.ndarray, salt) -> np.ndarray:
    """64-bit mix of values and a salt; wraps round."""
    with np.errstate(over="ignore"):
        x = values ^ (np.uint64(MIX) * (np.asarray(salt).astype(np.uint64) + np.uint64(1)))
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


FILED = "key bigint, fp bigint, used bigint"


def _rows(key, fp, used) -> pa.Table:
    columns = (np.ascontiguousarray(x, np.uint64).view(np.int64) for x in (key, fp, used))
    return pa.table(dict(zip(("key", "fp", "used"), columns)))


def unsigned(table, name: str) -> np.ndarray:
    return table.column(name).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def filed(fps: DataFrame, parts: list[Part]) -> DataFrame:
    """Rows (key, fp, used): buckets of every fingerprint; ``used``: bits of the key's part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = unsigned(batch, "fp")
            for number, part in enumerate(parts):
                used = np.uint64(mask_of(part.bits))
                for flip in flips(part):
                    key = mixed((fp & used) ^ flip, number)
                    yield from _rows(key, fp, np.full(len(fp), used)).to_batches()

    return fps.select("fp").mapInArrow(run, FILED)


def _refiled(rows: DataFrame, max_bits: int) -> DataFrame:
    """Rows of overfull buckets filed by the bits that their keys leave over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, fp, used = (unsigned(batch, c) for c in ("key", "fp", "used"))
            for mask in np.unique(used):
                at = used == mask
                free = [b for b in range(64) if not int(mask) >> b & 1]
                for number in range(max_bits + 1):
                    # every (max_bits + 1)th free bit: neighbours in a group differ alike
                    own = np.uint64(mask_of(free[number :: max_bits + 1]))
                    again = mixed(mixed(fp[at] & own, number) ^ key[at], 64 + number)
                    yield from _rows(again, fp[at], np.full(at.sum(), mask | own)).to_batches()

    return rows.mapInArrow(run, FILED)


def cells(fps: DataFrame, parts: list[Part], max_bits: int, cell: int = CELL) -> list[DataFrame]:
    """Filed rows in buckets of at most ``cell`` rows (more only when all bits are in keys)."""
    level, done = filed(fps, parts), []
    for _ in range(8):
        counts = level.groupBy("key").agg(F.count("*").alias("n"))
        full = written(counts.where(F.col("n") > cell).select("key"), "full-buckets")
        if full.isEmpty():
            break
        done.append(level.join(full, "key", "left_anti"))
        over = level.join(full, "key", "left_semi")
        # no bit left over: all rows of such a bucket are equal, or met by chance
        done.append(over.where(F.col("used") == -1))
        level = written(_refiled(over.where(F.col("used") != -1), max_bits), "buckets")
    return [*done, level]


def close_pairs(
    keys: np.ndarray, fps: np.ndarray, max_bits: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of equal key, sorted by key, whose fingerprints are close."""
    at, step = np.arange(len(keys)), 1
    while len(at):
        at = at[at + step < len(keys)]
        at = at[keys[at] == keys[at + step]]
        near = at[np.bitwise_count(fps[at] ^ fps[at + step]) <= max_bits]
        if len(near):
            yield near, near + step
        step += 1


def least_labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least place that each of ``n`` places is linked to, directly or not."""
    label = np.arange(n)
    while len(i):
        # roots are hooked onto lesser roots, then all places point to their root again
        a, b = label[i], label[j]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(label, up := label[label]):
            label = up
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
    return label


def _links_of(max_bits: int) -> Callable[[pa.Table], pa.Table]:
    def links(rows: pa.Table) -> pa.Table:
        key, fp = unsigned(rows, "key"), unsigned(rows, "fp")
        pairs = list(close_pairs(key, fp, max_bits))
        none = np.zeros(0, np.int64)
        i = np.concatenate([none, *(p[0] for p in pairs)])
        j = np.concatenate([none, *(p[1] for p in pairs)])
        label = least_labels(len(fp), i, j)
        moved = np.flatnonzero(label != np.arange(len(fp)))
        signed = fp.view(np.int64)
        return pa.table({"a": signed[moved], "b": signed[label[moved]]})

    return links


def links(fps: DataFrame, parts: list[Part], max_bits: int, cell: int = CELL) -> DataFrame:
    """(a, b): links of distinct fingerprints ``fp`` that give the same connected groups
    as all pairs within ``max_bits``."""
    found = [
        map_groups(rows, "key", _links_of(max_bits), "a bigint, b bigint")
        for rows in cells(fps, parts, max_bits, cell)
    ]
    return reduce(DataFrame.unionByName, found).where("a != b").distinct()
