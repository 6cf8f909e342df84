"""Relevance (F) and ingest bookkeeping."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from evidmap.operators import ingest, relevance
from evidmap.schemas import EXTRACTION, MANIFEST

ARTICLE = "pubmed_id string, title string, abstract string, mesh_terms array<string>"


@pytest.mark.parametrize(
    ("title", "abstract", "terms", "relevant"),
    [
        ("Test", None, ["Endometriosis", "Pain"], True),
        ("Test", None, ["ENDOMETRIOSIS"], True),
        ("Test", None, ["d004715"], True),
        ("Test", None, ["Endometriosis of bowel"], False),
        ("On the many faces of Endometriosis", None, [], True),
        ("Test", "One endometrioma, two cysts", [], True),
        ("Endometri", "osis", [], False),
        (None, "ADENOMYOSIS", None, True),
        ("Bees of the coast", "Their flight in rain.", [], False),
        ("Test", None, [None], False),
        (None, None, None, False),
    ],
)
def test_relevance(spark, title, abstract, terms, relevant):
    frame = spark.createDataFrame([("1", title, abstract, terms)], ARTICLE)
    assert relevance.relevant_articles(frame).count() == int(relevant)


def test_relevance_takes_another_vocabulary(spark):
    frame = spark.createDataFrame([("1", "Asthma in adults", None, [])], ARTICLE)
    assert relevance.relevant_articles(frame, terms=["Asthma"], keywords=["asthma"]).count() == 1


def test_null_conditions_reach_the_scan(spark, tmp_path):
    spark.range(5).select(F.col("id").alias("a"), F.col("id").alias("b")).write.parquet(str(tmp_path / "t"))
    kept = relevance.with_value(spark.read.parquet(str(tmp_path / "t")), "a")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(a)]" in plan


def moment(day):
    return datetime(2024, 1, day)


def test_manifest_write_keeps_checksum_and_time(spark, rows):
    stored = spark.createDataFrame([("a", "m1", 5, moment(1)), ("b", "m2", 6, moment(1))], MANIFEST)
    written = spark.createDataFrame([("b", "m9", 7, moment(2)), ("c", "m3", 8, moment(2))], MANIFEST)
    expected = [("a", "m1", 5, moment(1)), ("b", "m2", 7, moment(1)), ("c", "m3", 8, moment(2))]
    assert rows(ingest.upsert_manifest(stored, written)) == expected
    assert rows(ingest.current_manifest(stored.unionByName(written))) == expected
    assert rows(ingest.files_to_ingest(written, stored), "file_name") == [("c",)]


def test_first_copy_wins_and_stored_articles_stay(spark, rows):
    random.seed(1)
    copies = [
        (str(random.randint(0, 30)), f"f{random.randint(0, 3)}", random.randint(0, 2), i, f"t{i}")
        for i in range(300)
    ]
    copies += [("hot", "f1", 0, 1000 + i, f"h{i}") for i in range(200)]
    frame = spark.createDataFrame(
        copies, "pubmed_id string, source_file string, file_offset int, record_no int, title string"
    )
    stored = spark.createDataFrame([(str(i),) for i in range(0, 31, 3)], "pubmed_id string")
    first = {}
    for row in sorted(copies, key=lambda r: (r[1], r[2], r[3])):
        first.setdefault(row[0], row)
    expected = sorted(((r[0], r[4]) for r in first.values() if r[0] == "hot" or int(r[0]) % 3), key=repr)
    new = ingest.new_articles(frame, stored)
    assert rows(new, "pubmed_id", "title") == expected
    plan = new._jdf.queryExecution().executedPlan().toString()
    # copies are reduced in each task, before the shuffle
    assert "row_number(), 1, Partial" in plan


def test_children_keep_their_place(spark, rows):
    frame = spark.createDataFrame(
        [("1", [("a", "x"), ("b", None)]), ("2", []), ("3", None)],
        "pubmed_id string, authors array<struct<last_name:string,country:string>>",
    )
    assert rows(ingest.author_rows(frame)) == [("1", 0, "a", "x"), ("1", 1, "b", None)]


def extraction(spark, *entries):
    data = [
        (i, [t], [], [], design, None, conf, err, ts) for i, t, design, conf, err, ts in entries
    ]
    return spark.createDataFrame(data, EXTRACTION)


def test_extraction_write(spark, rows):
    stored = extraction(
        spark,
        ("1", "old", "other", 0.1, "e", moment(1)),
        ("2", "keep", "other", 0.2, None, moment(1)),
    )
    incoming = extraction(
        spark,
        ("1", "new", "cohort_study", 0.9, None, moment(5)),
        ("3", "first", "other", 0.3, None, moment(6)),
        ("3", "second", "other", 0.4, None, moment(7)),
    )
    written = ingest.upsert_extractions(stored, incoming).select(
        "pubmed_id", F.element_at("treatments", 1), "study_design", "extraction_error", "extracted_ts"
    )
    assert rows(written) == [
        ("1", "new", "cohort_study", None, moment(1)),
        ("2", "keep", "other", None, moment(1)),
        ("3", "second", "other", None, moment(6)),
    ]


def test_pending_abstracts(spark, rows):
    articles = spark.createDataFrame(
        [(str(i), f"a{i}" if i % 4 else None) for i in range(20)], "pubmed_id string, abstract string"
    )
    done = extraction(
        spark, ("1", "x", "other", 0.1, None, moment(1)), ("2", "x", "other", 0.1, "e", moment(1))
    )
    pending = sorted(str(i) for i in range(20) if i % 4 and i not in (1, 2))
    assert rows(ingest.pending_abstracts(articles, done, None), "pubmed_id") == [(i,) for i in pending]
    assert rows(ingest.pending_abstracts(articles, done, 5), "pubmed_id") == [(i,) for i in pending[:5]]
    retried = rows(ingest.pending_abstracts(articles, done, None, retry_failed=True), "pubmed_id")
    assert [i for i, in retried] == sorted([*pending, "2"])


def test_partition_sync(spark, rows):
    known = spark.createDataFrame([(1198,), (1200,), (1201,)], "file_number int")
    assert rows(ingest.partition_sync(spark, known, 1200, 1202)) == [
        (1198, "remove"), (1200, "keep"), (1201, "keep"), (1202, "add"),
    ]


@pytest.mark.parametrize("target", [1, 50, 10_000])
def test_budget_against_a_loop(spark, rows, target):
    random.seed(target)
    files = {n: random.randint(0, 20) for n in random.sample(range(3000), 120)}
    expected, total = [], 0
    for number in sorted(files, reverse=True):
        if total >= target:
            break
        total += files[number]
        expected.append((number, files[number], total))
    frame = spark.createDataFrame(list(files.items()), "file_number int, inserted bigint")
    kept = ingest.within_budget(frame, target, block=100).select("file_number", "inserted", "running")
    assert rows(kept) == sorted(expected, key=repr)


def test_ingest_summary(spark, rows):
    articles = spark.createDataFrame(
        [
            ("1", "endometriosis", "f1", 1), ("2", "other", "f1", 2), ("3", "endometriosis", "f1", 3),
            ("1", "endometriosis", "f2", 1), ("4", "endometriosis", "f3", 1),
        ],
        "pubmed_id string, title string, source_file string, record_no int",
    ).select("*", F.lit(None).cast("string").alias("abstract"), F.lit(0).alias("file_offset"),
             F.array().cast("array<string>").alias("mesh_terms"))
    files = spark.createDataFrame([("f1",), ("f2",), ("f3",), ("f4",)], "file_name string")
    manifest = files.where("file_name = 'f3'")
    stored = spark.createDataFrame([("3",)], "pubmed_id string")
    assert rows(ingest.ingest_summary(articles, stored, files, manifest)) == [
        ("f1", 3, 2, 1, "ingested"), ("f2", 1, 1, 0, "ingested"),
        ("f3", None, None, None, "skipped"), ("f4", 0, 0, 0, "ingested"),
    ]
