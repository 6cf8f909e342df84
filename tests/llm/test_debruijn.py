from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from evidmap.llm import debruijn as d
from evidmap.llm.words import hashed_texts, word_hashes

from .conftest import SCHEMA, prose


def plain(rows, window):
    """(id, text) -> (words, kept, removed) by one look at every window in order."""
    texts = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).digest()))
    # null and empty are one text
    seen, found, first = set(), {}, {}
    for i, text in texts:
        words = (text or "").encode().split()
        windows = [tuple(words[k : k + window]) for k in range(len(words) - window + 1)]
        gone = [False] * len(words)
        own = first.get((text or "", i))
        if own is None:
            for k, w in enumerate(windows):
                if w in seen:
                    gone[k : k + window] = [True] * window
                seen.add(w)
            own = first[(text or "", i)] = gone
        spans, kept = [], []
        for k, (w, g) in enumerate(zip(words, own)):
            if not g:
                kept.append(w)
            elif spans and spans[-1][1] == k:
                spans[-1][1] += 1
            else:
                spans.append([k, k + 1])
        found[(i, text or "")] = (len(words), b" ".join(kept).decode(), [tuple(s) for s in spans])
    return found


def compare(spark, rows, window, parts=3):
    data = [(i, t, "x", "s", 1, "l", k) for k, (i, t) in enumerate(rows)]
    docs = spark.createDataFrame(data, SCHEMA).repartition(parts)
    got = d.repeated_words(docs, window=window).collect()
    want = plain(rows, window)
    expected = sorted(
        (repr(i), *want[(i, t or "")][:2], str(want[(i, t or "")][2])) for i, t in rows
    )
    assert sorted((repr(r.id), r.n_words, r.kept, str([tuple(s) for s in r.removed])) for r in got) == expected


def test_like_a_plain_loop(spark, corpus):
    compare(spark, corpus, d.WINDOW)


@pytest.mark.parametrize("window", [2, 5, 20])
def test_few_words_many_branches(spark, window):
    rng = random.Random(window)
    rows = [(i, prose(rng, rng.randrange(0, 90), 3)) for i in range(25)]
    rows += [(50, "a " * 200), (51, "b a " * 100), (52, "a " * 150 + "c " + "a " * 60), (53, "x y z " * 40)]
    rows += [(60, " ".join(f"u{k}" for k in range(120))), (61, " ".join(f"u{k}" for k in range(40, 160)))]
    rows += [(62, " ".join(f"u{k}" for k in [*range(80, 120), *range(30)])), (10, rows[3][1]), (11, rows[3][1] + " a")]
    compare(spark, rows, window)


def test_words_end_at_ascii_blanks_only(spark):
    base = " ".join(f"wörd{k} {k} x" for k in range(30))
    rows = [(1, base), (2, base.replace(" ", "\t\n") + " end"), (3, base.replace(" ", " ")), (4, "\x1f".join("ab" * 30))]
    compare(spark, rows, 20)


def test_paths_of_many_chains_and_rings(spark):
    """Earliest places alternate between texts, so paths consist of many chains."""
    words = [f"p{k}" for k in range(300)]
    rows = [(k, " ".join(words[k * 7 : k * 7 + 14])) for k in range(40)] + [(99, " ".join(words))]
    ring = [f"r{k}" for k in range(12)]
    rows += [(200 + k, " ".join((ring * 3)[k : k + 8])) for k in range(12)] + [(300, " ".join(ring * 5))]
    compare(spark, rows, 4)


def test_ring_of_chains_is_opened_at_the_least(spark):
    place = "struct<number:bigint,at:int>"
    links = [((k, 0), ((k + 1) % 5, 0), 2) for k in range(5)] + [((9, 0), None, 0), ((10, 0), (9, 0), 3), ((11, 0), (10, 0), 4)]
    got = d.resolved(spark.createDataFrame(links, f"id {place}, up {place}, steps bigint"), d.Steps(spark))
    found = {r.id.number: (r.root.number, r.steps) for r in got.collect()}
    assert found == {0: (0, 0), 4: (0, 2), 3: (0, 4), 2: (0, 6), 1: (0, 8), 9: (9, 0), 10: (9, 3), 11: (9, 7)}


def test_hashes_do_not_depend_on_pieces(monkeypatch):
    rng = random.Random(1)
    texts = [prose(rng, n, 50) for n in (0, 3, 400, 1, 2000)] + [None, "  ", "y" * 3000 + " z"]
    want = [word_hashes((t or "").encode()).tolist() for t in texts]
    for size in (1, 64, 1000):
        monkeypatch.setattr("evidmap.llm.words.PIECE", size)
        monkeypatch.setattr("evidmap.llm.words.cut.__defaults__", (size,))
        got = []
        for _, counts, hashes in hashed_texts(pa.array(texts)):
            at = 0
            for n in counts:
                got.append(hashes[at : at + n].tolist())
                at += n
        assert got == want


def test_runs_hold_every_window_once(monkeypatch):
    rng = random.Random(2)
    texts = [prose(rng, n, 30) for n in (5, 19, 20, 21, 300, 0, 90)]
    for size in (1 << 20, 50):
        monkeypatch.setattr(d, "PIECE_WORDS", size)
        for _, counts, hashes in hashed_texts(pa.array(texts)):
            runs = d.Runs(counts, hashes, 20)
            windows = sorted((o, a + k) for o, a, n in zip(runs.owner.tolist(), runs.at.tolist(), runs.n.tolist()) for k in range(n))
            assert windows == [(o, k) for o, n in enumerate(counts) for k in range(n - 19)]


@pytest.mark.parametrize("window", [3, 8, 9, 20, 21])
def test_anchor_is_the_least_piece_of_every_window(window):
    words = random.Random(3)
    hashes = np.array([words.randrange(6) for _ in range(300)], np.uint64)  # many equal pieces
    runs = d.Runs([100, 0, 200], hashes, window)
    short = min(d.ANCHOR, window)
    pieces = d.rolled(hashes, short)
    own = [(0, k) for k in range(100 - window + 1)] + [(2, k) for k in range(200 - window + 1)]
    found = {}
    for text, at, n, anchor in zip(runs.owner.tolist(), runs.at.tolist(), runs.n.tolist(), runs.anchor.tolist()):
        found |= {(text, at + k): (anchor, at) for k in range(n)}
    assert sorted(found) == own
    first = {}  # windows with one place of the least piece are one run
    for text, k in own:
        start = k + (100 if text else 0)
        around = pieces[start : start + window - short + 1].tolist()
        place = start + around.index(min(around))
        assert found[text, k] == (min(around), first.setdefault((text, place), k))


def test_least_pieces_are_found_by_doubling(monkeypatch):
    """Five rounds at most for the 13 pieces of a window of 20, where each piece took a round."""
    rounds, where = [], np.where
    monkeypatch.setattr(np, "where", lambda *a: rounds.append(1) or where(*a))
    d.Runs([50], np.arange(50, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), 20)
    assert 0 < len(rounds) <= 10  # two columns a round


def test_a_passage_in_every_text(spark):
    rng = random.Random(4)
    passage = prose(rng, 60, 10_000)
    rows = [(i, f"{prose(rng, 10, 9000)} {passage} {prose(rng, 10, 9000)}") for i in range(400)]
    compare(spark, rows, 20, parts=8)


def test_empty(no_docs):
    got = d.repeated_words(no_docs)
    assert got.columns == ["id", "n_words", "kept", "removed"] and got.collect() == []


def test_a_window_of_one_word_is_refused(no_docs):
    with pytest.raises(ValueError):
        d.repeated_words(no_docs, window=1)


def test_places_are_whole_numbers_whose_minima_need_no_sorting(spark):
    rows = spark.range(1000).repartition(7).sortWithinPartitions("id").select("id", d.F.monotonically_increasing_id().alias("sparse"))
    rows = d.Steps(spark)(rows, "numbers")
    got = [(r.sparse, r.number) for r in d.numbered(rows).join(rows, "id").orderBy("sparse").collect()]
    assert [n for _, n in got] == list(range(1000))
    nodes = np.arange(3, dtype=np.int64).tobytes()
    runs = spark.createDataFrame([(0, 2, (5 << 31) + 7, 2, nodes)], "head bigint, tail bigint, place bigint, n bigint, nodes binary")
    windows = d.windows_of(runs)
    assert sorted((r.left, r.right, r.place) for r in windows.collect()) == [(0, 1, (5 << 31) + 7), (1, 2, (5 << 31) + 8)]
    least = windows.groupBy("left", "right").agg(d.F.min("place"))
    assert "SortAggregate" not in least._jdf.queryExecution().executedPlan().toString()
