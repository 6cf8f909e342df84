from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from evidmap.llm import language

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def model(real):
    return language.train(real.where(~language.held_out(F.col("doc_id"))))


def test_held_out_accuracy(real, model):
    test = real.where(language.held_out(F.col("doc_id")))
    found = language.identify(test, model).join(test, F.col("id") == F.col("doc_id"))
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.98


def test_mixtures_and_odd_texts(spark, real, model):
    texts = {r.lang: r.text for r in real.where("length(text) > 1500").dropDuplicates(["lang"]).collect()}
    rows = [(1, texts["en"][:900] + " " + texts["de"][:600]), (2, None), (3, " 12 %."), (4, "x"), (5, "日本語")]
    found = {r.id: r for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert set(found[1].shares) == {"en", "de"} and found[1].lang_pred == "en"
    assert sum(found[1].shares.values()) == pytest.approx(1, abs=1e-3)
    assert [found[k].lang_pred for k in (2, 3)] == ["und", "und"]
    assert found[2].score == found[3].score == 0.0
    assert all(found[k].lang_pred in model.languages and 0 <= found[k].score <= 1 for k in (4, 5))


def test_trigrams_do_not_cross_texts():
    is_letter = language.letters()
    both, owner = language.trigrams(["ab c", "d"], is_letter)
    one, _ = language.trigrams(["ab c"], is_letter)
    two, _ = language.trigrams(["d"], is_letter)
    assert both[owner == 0].tolist() == one.tolist()
    assert both[owner == 1].tolist() == two.tolist()
    assert len(language.trigrams(["1 2", ""], is_letter)[0]) == 0


def test_shares_maximise_the_likelihood():
    """Against a grid of mixtures of two languages."""
    rng = np.random.default_rng(5)
    chances = rng.dirichlet(np.ones(40) * 0.3, 2).T + 1e-4
    sample = np.concatenate([rng.choice(40, 300, p=chances[:, k] / chances[:, k].sum()) for k in (0, 0, 1)])
    grams, n = np.unique(sample, return_counts=True)
    share, like = language.fit(
        chances[grams], n.astype(float), np.zeros(len(grams), int), np.array([0]), np.ones((1, 2))
    )
    grid = np.linspace(0.001, 0.999, 999)
    values = [(np.log(chances[grams] @ [w, 1 - w]) * n).sum() for w in grid]
    assert share[0, 0] == pytest.approx(grid[int(np.argmax(values))], abs=0.02)
    assert like[0] == pytest.approx(max(values), abs=0.5)


def test_nothing_to_learn(docs, no_docs):
    nothing = language.train(no_docs)
    assert {(r.lang_pred, r.score) for r in language.identify(docs, nothing).collect()} == {("und", 0.0)}
    assert language.identify(no_docs, nothing).collect() == []


def test_stage_keeps_rows_and_columns(docs, corpus):
    kept = language.in_a_language(docs)
    assert kept.columns == docs.columns
    want = sorted(repr(i) for i, t in corpus if any(c.isalpha() for c in t or ""))
    assert sorted(repr(r.doc_id) for r in kept.collect()) == want


def test_stage_sends_each_text_once(docs, monkeypatch):
    sent, send = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda df, *a, **k: sent.append(df.columns) or send(df, *a, **k))
    kept = language.in_a_language(docs)
    assert sent[-1] == ["id"]  # the row, with its text inside
    model = language.train(docs.where(~language.held_out(F.col("doc_id"))))
    plain = language.identify(docs, model).where("lang_pred <> 'und'")
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(r.id) for r in plain.collect())
