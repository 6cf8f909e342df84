from __future__ import annotations

import random

import numpy as np
import pytest

from evidmap.llm import substrings, suffixes


def strings(rng):
    for alphabet in ("a", "ab", "abcdefgh \x00\xff"):
        for n in (1, 2, 3, 40, 600):
            text = "".join(rng.choice(alphabet) for _ in range(n)).encode("latin-1")
            yield text * (5 if n == 40 else 1)


def test_suffix_order_and_prefixes():
    zeros = b"\0" * suffixes.DEPTH
    for text in strings(random.Random(2)):
        data = np.frombuffer(text, np.uint8)
        keys = suffixes.word_keys(data)
        order = suffixes.suffix_order(data, keys)
        assert sorted(order.tolist()) == list(range(len(text)))
        sides = [(text[p : p + suffixes.DEPTH] + zeros)[: suffixes.DEPTH] for p in order]
        assert sides == sorted(sides)
        shared = suffixes.common_prefixes(order, keys, 100)
        for k in range(1, len(order)):
            pairs = zip(sides[k - 1][:100], sides[k][:100])
            assert shared[k] == next((n for n, (x, y) in enumerate(pairs) if x != y), 100)


def brute(rows):
    seen, found = set(), {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - 99):
            if data[s : s + 100] in seen:
                gone[s : s + 100] = True
            seen.add(data[s : s + 100])
        found[i] = bytes(np.frombuffer(data, np.uint8)[~gone]), int(gone.sum())
    return found


def run(docs, **options):
    out = {}
    for r in substrings.substring_dedup(docs, **options).collect():
        removed = sum(x.end - x.start for x in r.removed)
        assert all(a.end < b.start for a, b in zip(r.removed, r.removed[1:]))
        assert r.n_bytes == len(r.kept) + removed
        value = bytes(r.kept), removed
        assert out.setdefault(r.id, value) == value or r.id == 7
    return out


def repeated_rows():
    rng = random.Random(11)
    pool = ["".join(rng.choice("abé ") for _ in range(rng.randrange(80, 300))) for _ in range(8)]
    rows = []
    for i in range(40):
        parts = [rng.choice(pool)[rng.randrange(20) :] if rng.random() < 0.6 else
                 "".join(rng.choice("xyz") for _ in range(50)) for _ in range(6)]
        rows.append((i, "".join(parts)))
    rows += [(50, "q" * 5000), (51, "q" * 99), (52, "q" * 100), (53, "no" * 400), (54, None), (55, "")]
    rows += [(60, rows[3][1]), (61, rows[3][1] + "!"), (None, rows[4][1])]
    return rows


@pytest.mark.parametrize("frequent", [100_000, 3])
def test_against_plain_loops(spark, monkeypatch, frequent):
    rows = repeated_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert run(docs, frequent=frequent) == brute(rows)


def test_pieces_of_a_long_text():
    text = bytes(random.Random(1).choices(range(97, 101), k=3000))
    whole = substrings.anchors(np.frombuffer(text, np.uint8))
    chosen = np.repeat(whole[1], np.diff(np.append(whole[2], len(text) - 99)))
    cut = []
    for at, data in list(_small_pieces(text, 500)):
        _, places, first = substrings.anchors(data)
        cut.append(np.repeat(places, np.diff(np.append(first, len(data) - 99))) + at)
    assert np.array_equal(np.concatenate(cut), chosen)


def _small_pieces(text, size):
    data = np.frombuffer(text, np.uint8)
    for at in range(0, len(data) - 99, size):
        yield at, data[at : at + size + 99]


def test_awkward_rows(docs, corpus):
    rows = [r for r in dict.fromkeys(corpus) if r[0] != 7]
    got = run(docs.where("doc_id IS NULL OR doc_id != 7"))
    assert got == brute(rows)


def test_empty(no_docs):
    assert substrings.substring_dedup(no_docs).collect() == []
