"""Work on the groups of a sorted partition, some whole groups at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``key``.

    No more than a batch and the group that runs on over its end are held.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        last = int(group_starts(keys)[-1])
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = [batch.slice(last)]
        elif held and held[-1].column(key)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def map_groups(
    df: DataFrame, key: str, function: Callable[[pa.Table], pa.Table], schema: str, *order: str
) -> DataFrame:
    """``function`` over tables of whole groups of ``key``, rows of a group by ``order``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, key):
            yield from function(part).to_batches()

    dealt = df.repartition(key).sortWithinPartitions(key, *order)
    return dealt.mapInArrow(run, schema)


def group_starts(keys: np.ndarray) -> np.ndarray:
    """Places at which a new key begins."""
    if not len(keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
