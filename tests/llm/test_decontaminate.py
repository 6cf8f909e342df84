from __future__ import annotations

import random
import re

import pytest

from evidmap.llm import decontaminate as d

ITEM = "item_id bigint, text string"


def words(text):
    small = (text or "").translate(str.maketrans(d.UPPER, d.UPPER.lower()))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", small)


def brute(rows, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for p in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[p : p + n]), set()).add(str(item))
    found = []
    for i, text in rows:
        w, hit, names = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in windows:
                    hit |= set(range(p, p + n))
                    names |= windows[tuple(w[p : p + n])]
        found.append((i, len(w), len(hit), sorted(names)))
    return sorted(found, key=repr)


def run(docs, items):
    rows = d.contamination(docs, items).collect()
    assert all(sum(e - s for s, e in r.spans) == r.n_hit for r in rows)
    return sorted(((r.id, r.n_words, r.n_hit, list(r.item_ids)) for r in rows), key=repr)


def items_of(corpus):
    w = words(corpus[0][1])
    return [
        (1, " ".join(w[5:40])), (2, " ".join(w[5:40]).upper()), (3, " ".join(words(corpus[5][1])[3:16])),
        (10, "w7x w8x"), (11, "w9x"), (12, " ".join(words(corpus[2][1])[2:12])), (13, None), (14, " .,"),
        (15, " ".join(words(corpus[2][1])[2:10])),
    ]


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_against_plain_loops(spark, docs, corpus, monkeypatch, most):
    monkeypatch.setattr(d, "MAX_BROADCAST_ROWS", most)  # 0: everything meets in a shuffle
    items = items_of(corpus)
    assert run(docs, spark.createDataFrame(items, ITEM)) == brute(corpus, items)


def test_random_overlaps(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 60)))) for i in range(40)]
    items = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 20)))) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(docs, spark.createDataFrame(items, ITEM)) == brute(rows, items)


def test_empty_sides(spark, docs, no_docs, corpus):
    nothing = spark.createDataFrame([], ITEM)
    assert run(no_docs, spark.createDataFrame([(1, "a b")], ITEM)) == []
    assert run(docs, nothing) == brute(corpus, [])


def test_filter_keeps_columns_and_clean_rows(spark, docs, corpus):
    items = [(1, " ".join(words(corpus[0][1])[:30]))]
    kept = d.decontaminated(docs, spark.createDataFrame(items, ITEM))
    assert kept.columns == docs.columns
    want = [r[0] for r in brute(corpus, items) if not (r[2] and 20 * r[2] >= r[1])]
    assert sorted(map(repr, want)) == sorted(repr(r.doc_id) for r in kept.collect())
