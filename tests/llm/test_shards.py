from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from evidmap.llm import shards
from evidmap.runtime import new_folder


def write(spark, docs, **options):
    found = shards.write_shards(docs, new_folder(spark, "test-shards"), **options)
    return shards.with_slots(found).collect()


@pytest.mark.parametrize("bucket_bytes", [16 << 20, 2000])
def test_round_trip_slots_and_growth(spark, docs, corpus, bucket_bytes):
    rows = write(spark, docs, bucket_bytes=bucket_bytes)
    assert sorted(((r.doc_id, r.text) for r in rows), key=repr) == sorted(corpus, key=repr)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, shards.SHARDS)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    # id and number of shards decide
    by_id = defaultdict(set)
    for r in rows:
        by_id[r.doc_id].add(r.shard)
    assert all(len(v) == 1 for v in by_id.values())
    grown = {r.doc_id: r.grown_shard for r in rows}
    more = {r.doc_id: r.shard for r in write(spark, docs, shards=shards.SHARDS + 1)}
    assert more == grown


def test_order_does_not_depend_on_the_input_order(spark, docs):
    def order(df):
        rows = write(spark, df, bucket_bytes=3000)
        return sorted(((r.shard, r.slot, r.doc_id, r.text) for r in rows), key=repr)

    assert order(docs) == order(docs.repartition(7, F.rand(3)))


def test_shuffled(spark):
    """Neighbours in a shard are no neighbours in the input."""
    rows = write(spark, spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")))
    shard = [r.doc_id for r in sorted(rows, key=lambda r: r.slot) if r.shard == 0]
    assert 150 < len(shard) < 350
    rising = sum(a < b for a, b in zip(shard, shard[1:]))
    assert 0.4 < rising / len(shard) < 0.6


def test_clash_and_empty(spark, docs, no_docs):
    with pytest.raises(ValueError, match="shard"):
        write(spark, docs.withColumn("shard", F.lit(1)))
    assert write(spark, no_docs) == []
    assert {r.shard for r in write(spark, docs, shards=1)} == {0}
