"""Small corpora with the awkward rows that every operator and stage has to take."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, label string, key bigint"


def prose(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}x" for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text): prose, copies, near copies, shared passages; repeated and null rows."""
    rng = random.Random(5)
    passage = prose(rng, 60, 10_000)
    rows = []
    for i in range(40):
        text = prose(rng, rng.randrange(30, 200))
        if i % 5 == 0:
            text += "\n" + passage + "\n" + prose(rng, 20)
        rows.append((i, text))
    rows += [(100 + i, rows[i][1]) for i in range(6)]
    rows += [(200 + i, rows[i][1].replace("w7x", "w8x", 1) + " end") for i in range(6)]
    rows += [(300, None), (301, ""), (302, "  \n "), (303, "a"), (304, "ÄÖ é ñ"), (305, "\n\n\n")]
    rows += [(306, prose(rng, 40_000, 50_000)), (None, "no id at all " + passage)]
    rows += [rows[3], rows[3], (7, "another text under a known id")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with extra columns whose names the operators use themselves."""
    rows = [
        (i, t, None if k % 9 == 0 else "en" if k % 2 else "fr", f"s{k % 3}", len(t or ""), "x", k)
        for k, (i, t) in enumerate(corpus)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


class Groups:
    """Plain union-find."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


@pytest.fixture
def groups():
    return Groups()
