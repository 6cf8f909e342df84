from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from evidmap.llm import hamming, simhash
from evidmap.llm.components import components
from evidmap.llm.hamming import Part


def brute_print(text):
    small = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = re.findall(r"[^\x20\x09-\x0D]+", small)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n", "A", "a B", "a b C", "x y z x y z", "é Ä b c d e"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_print(text)


def test_pieces_of_a_long_text(corpus, monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 100)
    long = next(t for i, t in corpus if i == 306)[:5000]
    monkeypatch.setattr(simhash.text_pieces, "__defaults__", (100,))
    assert simhash.fingerprint(long) == brute_print(long)
    assert simhash.fingerprint("y" * 1000 + " b") == brute_print("y" * 1000 + " b")


def close(rows, groups, bits=3):
    prints = [(i, brute_print(t)) for i, t in rows]
    names = {fp for _, fp in prints}
    for a in names:
        groups.find(a)
        for b in names:
            if (a ^ b).bit_count() <= bits:
                groups.join(a, b)
    least = {}
    for i, fp in prints:
        if i is not None:
            root = groups.find(fp)
            least[root] = min(least.get(root, i), i)
    return sorted(((i, fp, least.get(groups.find(fp))) for i, fp in prints), key=repr)


def test_against_plain_loops(docs, corpus, groups):
    got = simhash.near_duplicates(docs).collect()
    got = sorted(((r.id, r.fp & (1 << 64) - 1, r.component_id) for r in got), key=repr)
    assert got == close(corpus, groups)


def test_one_row_of_each_group_stays(docs, corpus, groups):
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    close(corpus, groups)
    seen = Counter(groups.find(brute_print(r.text)) for r in kept.collect())
    assert set(seen) == {groups.find(brute_print(t)) for _, t in corpus}
    assert set(seen.values()) == {1}


def test_empty(no_docs):
    assert simhash.near_duplicates(no_docs).collect() == []
    assert simhash.one_per_group(no_docs).collect() == []


def clustered(seed, n):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 62, 6, dtype=np.uint64)
    out = set()
    for _ in range(n):
        fp = int(rng.choice(centres))
        for b in rng.integers(0, 64, rng.integers(0, 5)):
            fp ^= 1 << int(b)
        out.add(fp)
    return sorted(out)


@pytest.mark.parametrize("cell", [5, 2000])
@pytest.mark.parametrize(
    "parts",
    [
        hamming.even_parts(3),
        [Part(tuple(range(0, 40)), 1), Part(tuple(range(40, 64)), 1)],
        [Part(tuple(range(0, 10)), 0), Part(tuple(range(10, 30)), 0), Part(tuple(range(30, 64)), 1)],
    ],
)
def test_links_find_every_group(spark, groups, parts, cell):
    fps = clustered(1, 400)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    found = hamming.links(spark.createDataFrame(signed, "fp bigint"), parts, 3, cell)
    for row in found.collect():
        groups.join(row.a & (1 << 64) - 1, row.b & (1 << 64) - 1)
    from tests.llm.conftest import Groups

    want = Groups()
    for k, a in enumerate(fps):
        for b in fps[:k]:
            if (a ^ b).bit_count() <= 3:
                want.join(a, b)
    assert [groups.find(f) for f in fps] == [want.find(f) for f in fps]


@given(st.lists(st.lists(st.floats(0, 100), min_size=5, max_size=5), min_size=2, max_size=4))
@settings(max_examples=40, deadline=None)
def test_allocation_is_the_cheapest(costs):
    from itertools import product

    costs = np.array(costs)
    total = 3 - len(costs) + 1
    best, chosen = simhash.allocate(costs, total)
    ways = [w for w in product(range(-1, 4), repeat=len(costs)) if sum(w) == total]
    cheapest = min(sum(costs[i, t + 1] for i, t in enumerate(w)) for w in ways)
    assert sum(chosen) == total and best == pytest.approx(cheapest)


def test_bits_are_grouped_once():
    rng = np.random.default_rng(2)
    bits = rng.integers(0, 2, (500, 64)).astype(float)
    bits[:, 40] = bits[:, 3]
    cut = simhash.group_bits(500, bits.T @ bits, 4)
    assert sorted(b for part in cut for b in part) == list(range(64))
    assert any({3, 40} <= set(part) for part in cut)


def test_components(spark, groups):
    rng = np.random.default_rng(4)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(500 + i, 501 + i) for i in range(40)]
    pairs += [(1000, i) for i in range(1001, 1200)] + [(5, 5)]
    for a, b in pairs:
        groups.join(a, b)
    got = components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r.node: r.label for r in got.collect()} == {x: groups.find(x) for p in pairs for x in p}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
