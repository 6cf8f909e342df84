from __future__ import annotations

import pyarrow as pa
import pytest

pytest.importorskip("corpus_pipeline")

import corpus_pipeline as pipeline  # noqa: E402
from evidmap.llm.tables import BATCH_BYTES, released, written  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_stages_one_after_the_other(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns
        assert 0.7 * before < docs.count() <= before
    pieces = pipeline.packing(spark, docs, FOLDER).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.select("doc_id").collect()}
    whole = sorted(map(tuple, pipeline.run(spark, FOLDER).collect()))
    assert [r[:2] + r[2:5] for r in whole] == sorted(tuple(r)[:5] for r in pieces)


@pytest.mark.parametrize(("name", "stage"), pipeline.STAGES)
def test_awkward_and_empty_tables(spark, docs, no_docs, name, stage):
    stage(spark, docs, FOLDER).collect()
    assert stage(spark, no_docs, FOLDER).collect() == []


@pytest.mark.parametrize("stage", [pipeline.language, pipeline.lines, pipeline.near_duplicates, pipeline.packing])
def test_batches_for_workers_are_bounded_by_bytes(spark, docs, stage):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    spark.conf.unset(BATCH_BYTES)
    stage(spark, docs, FOLDER)
    rows = spark.range(0, 6000, 1, 1).selectExpr("repeat('x', 2000) AS text")
    found = [r.n for r in rows.mapInArrow(sizes, "n bigint").collect()]
    assert sum(found) > 12_000_000 and max(found) <= 5_000_000
    spark.conf.set(BATCH_BYTES, "8m")
    stage(spark, docs, FOLDER)
    assert spark.conf.get(BATCH_BYTES) == "8m"
    spark.conf.unset(BATCH_BYTES)


def test_workers_give_memory_back_between_batches(monkeypatch):
    held, kept = [], []

    class Pool:
        def release_unused(self):
            kept.append(len(held))

    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    for batch in released(iter("abc")):
        held.append(batch)
    assert held == ["a", "b", "c"] and kept == [1, 2, 3]
