from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from evidmap.llm import quality as q

FOLDER = "/root/testdata/sf0.01"


def test_accuracies_of_planted_labellers():
    """Votes drawn with known accuracies, independent given the class."""
    rng = np.random.default_rng(8)
    good = rng.random(20_000) < 0.8
    right = np.array([0.95, 0.9, 0.85, 0.8, 0.9])
    votes = np.where(
        rng.random((20_000, 5)) < right, np.where(good, q.GOOD, q.BAD)[:, None], np.where(good, q.BAD, q.GOOD)[:, None]
    )
    votes[rng.random(votes.shape) < 0.1] = q.SHORT
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = q.fit_labels(patterns, counts.astype(float))
    assert model.prior == pytest.approx(0.8, abs=0.03)
    assert model.accuracies() == pytest.approx(right, abs=0.03)
    # the best guess possible is little better than the model's
    assert ((model.posterior(votes) > 0.5) == good).mean() > 0.96


def test_labels_are_met(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = q.quality(docs, *q.train(docs)).join(labels, F.col("id") == F.col("doc_id"))
    right = found.groupBy("quality").agg(F.avg(((F.col("score") >= 0.5) == (F.col("quality") == 1)).cast("double")))
    shares = {r[0]: r[1] for r in right.collect()}
    assert shares[0] > 0.9 and shares[1] > 0.95


@pytest.mark.parametrize(
    ("text", "rule"),
    [
        ("Der " * 60, "echoes"),
        ("One two three. " + "w%%% " * 30, "symbols"),
        ("THE CAT SAT ON THE MAT AND LEFT.", "capitals"),
        ("a | b | c | d | e | f", "columns"),
    ],
)
def test_rules(text, rule):
    assert q.votes(*q.statistics(text))[q.STATISTICS.index(rule)] == q.BAD


def test_awkward_rows(docs, no_docs, corpus):
    model, scorer = q.train(docs)
    rows = q.quality(docs, model, scorer).collect()
    assert len(rows) == len(corpus)
    assert {r.score for r in rows if r.id in (300, 301, 302, 305)} == {0.0}
    assert all(0 <= r.score <= 1 and 0 <= r.weak_label <= 1 for r in rows)
    assert len({r.score for r in rows if r.id == 3}) == 1
    assert q.quality(no_docs, *q.train(no_docs)).collect() == []
