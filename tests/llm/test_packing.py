from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from evidmap.llm import packing
from evidmap.llm.bpe import Merges


@pytest.fixture(scope="module")
def path():
    return packing.public_tokenizer()


def ids_of(tokenizer, text):
    found = tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END]
    return np.array(found, "<u4").tobytes()


def test_words_are_encoded_like_texts(path):
    tokenizer, words = Tokenizer.from_file(path), packing.WordTokens(path)
    for c in list(range(0x180)) + [0x3A3, 0x130, 0x301, 0x2028, 0x4E00, 0x1F600, 0x3000]:
        for text in (chr(c), f"a{chr(c)}b", f"{chr(c)}'s {chr(c)}{chr(c)}9", f"A{chr(c)} {chr(c)}ÉΣ"):
            assert words.texts([text or ""])[0] == ids_of(tokenizer, text), (c, text)
    for text in (None, "", "<|endoftext|> x", "I'll we've x'S", "é Å"):
        assert words.texts([text or ""])[0] == ids_of(tokenizer, text)


def test_merges_give_the_ids_of_the_tokenizer(path):
    """Words of all kinds of signs, merged together, against the library word by word."""
    rng = np.random.default_rng(7)
    signs = [chr(c) for c in range(33, 256) if not chr(c).isspace() and c not in (0x27, *range(0x7F, 0xA1))]
    signs = [c for c in signs if c == c.lower()]
    letters = list("etaoinshrdlucmfwygpbvk")
    words = {"".join(rng.choice(letters, rng.integers(1, 20))) for _ in range(4000)}
    words |= {"".join(rng.choice(signs, rng.integers(1, 12))) for _ in range(2000)}
    words |= {"".join(rng.choice([*letters, "é", "ü", "ß", "1", ",", "."], rng.integers(1, 30))) for _ in range(2000)}
    words |= {"aaaaaaa", "the", "x" * 64, "123", "a1b2", "é", "..", "ééé"}
    words, tokenizer = sorted(words), Tokenizer.from_file(path)
    found = Merges(path).encode(words)
    assert [f + np.array([packing.END], "<u4").tobytes() for f in found] == [ids_of(tokenizer, w) for w in words]
    assert Merges(path).encode([]) == []


def test_pieces_of_a_long_text(path, corpus):
    text = next(t for i, t in corpus if i == 306)[:4000] + "\nΣ" + "y" * 400 + " Σ"
    words = packing.WordTokens(path)
    cut = list(packing.pieces(text, 50))
    assert "".join(cut) == text and max(map(len, cut[:-2])) <= 50
    assert words.texts([text, "a b"]) == [ids_of(words.tokenizer, text), ids_of(words.tokenizer, "a b")]


def test_table_of_words_begins_anew(path, monkeypatch):
    words = packing.WordTokens(path)
    monkeypatch.setattr(packing.WordTokens, "MOST_WORDS", 3)
    texts = [f"word{k} other{k % 3} it's" for k in range(20)]
    for k in range(0, 20, 4):
        assert words.texts(texts[k : k + 4]) == [ids_of(words.tokenizer, t) for t in texts[k : k + 4]]


@pytest.mark.parametrize(("window", "shard_docs"), [(2048, 512), (256, 7)])
def test_round_trip(docs, corpus, path, window, shard_docs):
    rows = packing.pack(docs, path, window=window, shard_docs=shard_docs).collect()
    tokenizer = Tokenizer.from_file(path)
    own_ids = {t: ids_of(tokenizer, t) for _, t in corpus}
    want = Counter((i, own_ids[t]) for i, t in corpus)
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        documents[r.id].append(r)
        assert len(r.ids) == 4 * r.length
    for row in sequences.values():
        at = 0
        for r in sorted(row, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == window or (at < window and at & (at - 1) == 0)
    for i, text in corpus:
        if sum(c for (j, _), c in want.items() if j == i) == 1:
            own = sorted(documents[i], key=lambda r: r.start)
            assert b"".join(r.ids for r in own) == own_ids[text]
            assert all(r.doc_tokens == len(own_ids[text]) // 4 for r in own)
    assert sum(r.length for r in rows) == sum(len(ids) // 4 * n for (_, ids), n in want.items())


def test_neighbours_are_those_of_plain_bm25():
    rng = np.random.default_rng(1)
    tails = [rng.integers(0, 50, rng.integers(1, 80)) for _ in range(30)]
    weight = rng.random(50) * (rng.random(50) > 0.2)
    index = packing.Shard(tails, weight, 40.0)
    for seed in range(30):
        got = index.neighbours(seed)
        for doc in range(30):
            score = 0.0
            for term in set(tails[seed].tolist()):
                tf = (tails[doc] == term).sum()
                norm = packing.K1 * (1 - packing.B + packing.B * len(tails[doc]) / 40.0)
                score += weight[term] * tf * (packing.K1 + 1) / (tf + norm) if tf else 0
            assert got[doc] == pytest.approx(score)


def test_like_documents_share_windows():
    """Two subjects in turn: a window is filled from one of them."""
    rng = np.random.default_rng(3)
    tails = [rng.integers(100 * (k % 2), 100 * (k % 2) + 100, 60) for k in range(40)]
    index = packing.Shard(tails, np.ones(200), 60.0)
    windows, rest = packing.pack_shard([(0, 60)] * 40, index, 300)
    mixed = sum(len({d % 2 for d, _, _ in row}) > 1 for row in windows)
    assert len(windows) == 8 and mixed <= 1 and rest == []


def test_empty(no_docs, path):
    assert packing.pack(no_docs, path).collect() == []


def test_workers_load_tables_once_and_the_tokenizer_when_needed(path):
    first, second = packing.WordTokens(path), packing.WordTokens(path)
    assert first.merges is second.merges
    first.texts(["plain words only"])
    assert "tokenizer" not in vars(first)
    whole = Tokenizer.from_file(path).encode("it's 日本", add_special_tokens=False).ids
    assert np.frombuffer(first.texts(["it's 日本"])[0], "<u4").tolist() == [*whole, packing.END]
    assert "tokenizer" in vars(first)


@pytest.mark.parametrize("terms", [40, 1 << 17])
def test_index_counts_the_terms_of_each_document(terms):
    draw = np.random.default_rng(5)
    tails = [draw.integers(0, 40, n).astype("<u4") for n in (1, 30, 200, 7)]
    weight = np.where(np.arange(terms) % 3 == 0, 0.0, 1.0 + np.arange(terms) % 40)
    index = packing.Shard(tails, weight, 50.0)
    found = {(d, t): s for d, t, s in zip(index.docs.tolist(), index.terms.tolist(), index.scores.tolist())}
    plain = {}
    for number, ids in enumerate(tails):
        norm = packing.K1 * (1 - packing.B + packing.B * len(ids) / 50.0)
        for term in set(ids.tolist()):
            if weight[term] > 0:
                n = ids.tolist().count(term)
                plain[number, term] = weight[term] * n * (packing.K1 + 1) / (n + norm)
        assert index.own[number].tolist() == sorted(t for d, t in plain if d == number)
    assert found == pytest.approx(plain) and index.terms.tolist() == sorted(index.terms.tolist())


def test_runs_are_kept_once_whatever_stands_beside_them(path):
    """Words that differ by signs and digits only are made of known runs."""
    tokens, tokenizer = packing.WordTokens(path), Tokenizer.from_file(path)
    texts = [f"Alpha{sign}beta{k}{sign} {sign}" for sign in ",.;!?" for k in range(40)]
    assert tokens.texts(texts) == [ids_of(tokenizer, t) for t in texts]
    # the end, the blank, two words, five signs, ten digits
    assert len(tokens.runs) == 19 and len(set(tokens.runs.to_pylist())) == 19


def test_texts_together_have_the_ids_of_the_tokenizer(path, monkeypatch):
    monkeypatch.setattr(packing.WordTokens, "MOST_WORDS", 300)
    rng = np.random.default_rng(11)
    signs = list("abcdeTHE  '\n\t.,-_019") + ["'s ", "\x85", "\xa0", "é", "É", "ß", "日", "\x00", "\x7f", "<|", "z" * 70]
    texts = ["".join(rng.choice(signs, rng.integers(0, 60))) for _ in range(1500)]
    tokens, tokenizer = packing.WordTokens(path), Tokenizer.from_file(path)
    found = [ids for at in range(0, len(texts), 100) for ids in tokens.texts(texts[at : at + 100])]
    assert found == [ids_of(tokenizer, t) for t in texts]


def test_long_plain_texts_are_cut(path, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 50)
    monkeypatch.setattr(packing.pieces, "__defaults__", (40,))
    tokens, tokenizer = packing.WordTokens(path), Tokenizer.from_file(path)
    texts = ["it's one of many words, " * 30, "short", "x" * 130 + " y"]
    assert tokens.texts(texts) == [ids_of(tokenizer, t) for t in texts]
