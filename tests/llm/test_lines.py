from __future__ import annotations

import random

import numpy as np
import pytest

from evidmap.llm import hamming, lines
from tests.llm.conftest import Groups, prose


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(400):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(12)))
        b = "".join(rng.choice("abc") for _ in range(rng.randrange(12)))
        true = levenshtein(a, b)
        assert lines.edit_distance(a, b, 30) == true
        most = rng.randrange(6)
        assert (lines.edit_distance(a, b, most) <= most) == (true <= most)
    assert lines.edit_distance("x" * 500 + "a" * 90, "x" * 500 + "b" * 90, 100) == 90


def plain_print(words):
    def mix(x):
        for step in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            x = (x ^ x >> 33) * step & (1 << 64) - 1
        return x ^ x >> 33

    hashes = [
        mix((sum(b * pow(lines.BYTE_STEP, k, 1 << 64) for k, b in enumerate(w)) + len(w)) & (1 << 64) - 1)
        for w in words
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """Places removed of each row, by comparing all lines."""
    found = {}
    for i, text in dict.fromkeys(rows):
        for at, line in enumerate((text or "").encode().split(b"\n")):
            words = lines.words_of(line)
            if len(words) >= lines.MIN_WORDS:
                found.setdefault(b" ".join(words), []).append((i is None, i or 0, text, at))
    names = sorted(found)
    fps = np.array([plain_print(n.split(b" ")) for n in names], np.uint64)
    groups = Groups()
    for k in range(len(names)):
        groups.find(k)
        for j in np.flatnonzero(np.bitwise_count(fps[:k] ^ fps[k]) <= 3):
            a, b = names[k].decode(), names[j].decode()
            if levenshtein(a, b) <= 0.2 * max(len(a), len(b)):
                groups.join(k, int(j))
    members = {}
    for k, name in enumerate(names):
        members.setdefault(groups.find(k), []).extend(found[name])
    gone = {}
    for places in members.values():
        for none, i, text, at in sorted(places, key=lambda p: (p[0], p[1], p[3]))[1:]:
            gone.setdefault((None if none else i, text), []).append(at)
    return gone


def line_rows():
    rng = random.Random(9)
    base = [prose(rng, rng.randrange(5, 60), 3000) for _ in range(25)]
    rows = []
    for i in range(60):
        own = []
        for _ in range(rng.randrange(1, 6)):
            line = rng.choice(base)
            if rng.random() < 0.5:
                words = line.split(" ")
                words[rng.randrange(len(words))] += rng.choice(["s", "", "!!", "q"])
                line = " ".join(words)
            own.append(line)
        rows.append((i, "\n".join(own + ["", "too short"])))
    return rows


@pytest.mark.parametrize(("cell", "most"), [(2000, 1_000_000), (3, 0)])
def test_against_plain_loops(spark, monkeypatch, cell, most):
    monkeypatch.setattr(lines, "MAX_BROADCAST_ROWS", most)
    rows = line_rows()
    got = lines.line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), cell=cell).collect()
    gone = brute(rows)
    texts = dict(rows)
    assert sum(map(len, gone.values())) > 30
    for r in got:
        want = sorted(gone.get((r.doc_id, texts[r.doc_id]), []))
        assert list(r.removed) == want
        assert r.text == "\n".join(x for k, x in enumerate(texts[r.doc_id].split("\n")) if k not in want)


def test_awkward_rows(docs, corpus):
    got = lines.line_dedup(docs)
    assert set(docs.columns) < set(got.columns)
    rows = got.collect()
    assert len(rows) == len(corpus)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[300].text is None and by_id[300].n_lines == 0
    assert by_id[301].text == "" and by_id[305].text == "\n\n\n"
    assert by_id[100].n_removed > 0  # a copy loses its lines
    # equal rows share their decisions
    same = [r for r in rows if r.doc_id == 3]
    assert len(same) == 3 and len({(r.text, r.n_removed) for r in same}) == 1


def test_stage_drops_only_emptied_documents(docs, corpus):
    kept = lines.without_repeats(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {300, 301, 302, 303, 304, 305, 306} <= ids
    assert not ids & {101, 102, 103, 104}


def test_empty(no_docs):
    assert lines.line_dedup(no_docs).collect() == []


def test_prints():
    """More words than a byte can count, lines at the edges, short ones in between."""
    texts = [b"a " * 700 + b"b " * 300 + b"\nx y", b"", b"\n\nA-B c,d 7 \xc3\xa9", b"a b c d 9 \xc3\xa9\n"]
    owner, at, names, fps = lines.line_prints(texts)
    assert list(zip(owner.tolist(), at.tolist())) == [(0, 0), (2, 2), (3, 0)]
    want = [plain_print([b"a"] * 700 + [b"b"] * 300)] + [plain_print(b"a b c d 0 \xc3\xa9".split())] * 2
    assert fps.tolist() == want
    assert names[1].tolist() == names[2].tolist() != names[0].tolist()
    assert len(lines.line_prints([b"", b"\n"])[0]) == 0
    assert hamming.mask_of([0, 63]) == 1 | 1 << 63


def test_short_lines_and_scripts_without_spaces(spark):
    """Exact copies of few words but many characters go, also in scripts without spaces."""
    chinese, thai = "版权所有未经许可不得转载", "สงวนลิขสิทธิ์ห้ามทำซ้ำ"
    latin, few = "Copyright-protected documentation", "Read more"
    other = "本文讨论北方地区的气候与农业"
    text = "\n".join([chinese, thai, latin, few])
    rows = [(1, text), (2, f"{other}\n{text}"), (3, "版权所有")]
    got = {r.doc_id: r for r in lines.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].text == text and got[3].text == "版权所有"
    assert list(got[2].removed) == [1, 2, 3] and got[2].text == f"{other}\n{few}"


def test_words_of_wide_signs():
    _, at, names, fps = lines.line_prints(["ab日本cd x\n日 本 ab cd x".encode()])
    assert at.tolist() == [0, 1] and names[0].tolist() != names[1].tolist()
    assert fps[0] == plain_print([w.encode() for w in ("ab", "日", "本", "cd", "x")])
