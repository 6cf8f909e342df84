from __future__ import annotations

import hashlib

from evidmap.llm import fingerprints as fp


def ordered(rows):
    """By descending id, null ids last, then by descending text."""
    return sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()), reverse=True)


def test_next_edit_and_root(spark, docs, corpus):
    got = [(r.id, r.n_chars, r.edited) for r in fp.fingerprints(docs).collect()]
    rows = ordered(corpus)
    want = []
    for k, (i, text) in enumerate(rows):
        half = len(text) // 2
        following = rows[(k + 1) % len(rows)][1]
        want.append((i, len(text), text[: len(text) - half] + following[:half]))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_equal_texts_have_equal_roots_and_edits_are_located(spark):
    text = "one two. three\nfour\n\nfive six\nseven"
    rows = [(1, text), (2, text), (3, text.replace("seven", "eight"))]
    df = fp.merkle_tree(spark.createDataFrame(rows, "id long, text string"), "text")
    a, b, c = df.orderBy("id").collect()
    assert a.root == b.root != c.root
    assert a.sections[0] == c.sections[0] and a.sections[1] != c.sections[1]
    assert a.paragraphs[1][0] == c.paragraphs[1][0] and a.paragraphs[1][1] != c.paragraphs[1][1]
    leaf = [hashlib.sha256(p.encode()).hexdigest() for p in ("five six", "seven")]
    assert a.paragraphs[1] == leaf


def test_changed_branch(spark):
    df = spark.createDataFrame([(2, "a b\nc d\n\ne f\ng h i j k"), (1, "zz zz zz zz zz")], "doc_id long, text string")
    row = fp.fingerprints(df).where("id = 2").first()
    assert (row.changed_section, row.changed_paragraph) == (1, 0)
    assert 0 < row.near_edited < 1 and row.near_next == 0.0


def test_likeness_bounds(docs):
    rows = fp.fingerprints(docs).collect()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)


def test_one_document_follows_itself(spark):
    row = fp.fingerprints(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).first()
    assert (row.edited, row.near_next) == ("abab", 1.0)


def test_empty(no_docs):
    assert fp.fingerprints(no_docs).collect() == []
