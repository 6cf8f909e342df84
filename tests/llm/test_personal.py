from __future__ import annotations

import random
import re

import numpy as np
import pytest

from evidmap.llm import personal as p

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def brute(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == 2 and not (13 <= len(digits) <= 19 and p.luhn(digits)):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            found.append((kind, m.start(), m.end()))
    return found


def test_base_spans():
    rng = random.Random(1)
    for alphabet in ("12. +-@ab(", "1234567890", "0123 -", "a@b.-", "+12 ()-.", "٣1.@é"):
        for _ in range(1500):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(50)))
            assert p.base_spans(text) == brute(text), text
    card = "4111 1111-1111 1111"
    assert p.base_spans(f"{card}, a.b@c.de +1 (555) 010-9999 1.2.3.4") == brute(f"{card}, a.b@c.de +1 (555) 010-9999 1.2.3.4")


@pytest.mark.parametrize("text", ["1" * 200_000, "1." * 100_000, "a" * 100_000 + "@", "+1" * 100_000, "a@" * 50_000])
def test_long_runs_take_linear_time(text):
    assert isinstance(p.base_spans(text), list)


def ways(lattice, start=0):
    """All ways to cut a region: tuples of (segment, kind)."""
    if start == lattice.n:
        yield ()
        return
    for rest in ways(lattice, start + 1):
        yield rest
    for k, (i, j, _, _) in enumerate(lattice.segments):
        if i == start:
            for kind in range(len(p.KINDS)):
                for rest in ways(lattice, j):
                    yield ((k, kind), *rest)


def test_chances_and_best_cut_against_all_ways():
    rng = np.random.default_rng(3)
    field = p.Field()
    lattice = p.Lattice("x 1 2.3 a")
    for row in lattice.features:
        for f in row:
            field.weights.setdefault(f, rng.normal(size=4))
    scores = field.scores(lattice.features)
    values = {w: sum(scores[k, kind] for k, kind in w) for w in ways(lattice)}
    total = sum(np.exp(v) for v in values.values())
    chance = field.marginals(lattice, scores)
    for k in range(len(lattice.segments)):
        for kind in range(4):
            want = sum(np.exp(v) for w, v in values.items() if (k, kind) in w) / total
            assert chance[k, kind] == pytest.approx(want)
    best = max(values, key=values.get)
    got = [(lattice.at[s, e], kind) for kind, s, e, _ in field.best(lattice)]
    assert sorted(got) == sorted(best)


def examples(n=80):
    rng, out = random.Random(4), []
    for _ in range(n):
        number = f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
        out += [f"call me at +1 {number} or not", f"write to {rng.choice('abc')}o{rng.randrange(99)}@mail{rng.randrange(9)}.example.com now"]
        out += [f"host {'.'.join(str(rng.randrange(256)) for _ in range(4))} is up", f"in {rng.randrange(1900, 2030)} there were {rng.randrange(99)} of"]
    return out


def test_field_adds_what_the_patterns_just_miss():
    field = p.fit(examples())
    text = "please call (415) 555-0137 at noon, in 2001 or 1999"
    added = p.added_spans(text, p.base_spans(text), field)
    assert [(p.KINDS[k], text[s:e]) for k, s, e in added] == [("phone", "(415) 555-0137")]
    plain = "in 1987 there were 45 of 300 and 7.5 percent"
    assert p.added_spans(plain, [], field) == []


def test_rows(docs, spark, corpus):
    extra = spark.createDataFrame([(900, "mail a.b@c.de or 1.2.3.4"), (901, None)], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(extra)
    field = p.fit(p.training_regions(both, "text"))
    rows = p.personal_data(both, field).collect()
    assert len(rows) == len(corpus) + 2
    found = {r.id: r for r in rows}
    assert [tuple(x) for x in found[900].base] == [("email", 5, 13), ("ip", 17, 24)]
    assert found[901].base == found[901].spans == [] == found[300].spans
    for r in rows:
        assert set(map(tuple, r.base)) <= set(map(tuple, r.spans))


def test_nothing_to_learn(no_docs, docs):
    assert p.training_regions(no_docs, "text") == []
    field = p.fit([])
    assert all(r.base == r.spans for r in p.personal_data(docs, field).collect())
    assert p.personal_data(no_docs, field).collect() == []
