"""Byte-pair ids of many words at once, with numpy, from the rank table of a public tokenizer.

Words of about one length are the rows of a matrix of symbols, filled up at the end. In a round every row that has a pair in the
table merges its best one (the least rank, then the leftmost), so rows stay of one length; rows
without such a pair are done. Only the two pairs beside a merge are looked up again.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np

SLOT_BITS = 17
SLOTS = 1 << SLOT_BITS
NONE = np.int32(np.iinfo(np.int32).max)
FREE = np.uint32(0xFFFFFFFF)
BLANK, LETTER, DIGIT, OTHER = range(4)
LONGEST = 64  # longer words are left to the library
TOGETHER = 8  # runs of up to so many signs, then up to twice as many, ... are rows of one matrix
PAD = 0xFFFF  # fills a row; in no pair of the table


def _kind(char: str) -> int:
    category = unicodedata.category(char)
    if char.isspace():
        return BLANK
    return LETTER if category[0] == "L" else DIGIT if category[0] == "N" else OTHER


KIND = np.array([_kind(chr(b)) for b in range(256)], np.uint8)


def _byte_chars() -> list[str]:
    """The character that stands for each byte: itself where it can be printed, else one of 256 and up."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Merges:
    """Symbols of bytes and ranked pairs of a tokenizer file with word ends."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        end, vocabulary = model["end_of_word_suffix"], model["vocab"]
        if model["type"] != "BPE" or not end or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("no table of byte pairs with word ends")
        chars = _byte_chars()
        self.inner = np.array([vocabulary[c] for c in chars], np.int32)
        self.last = np.array([vocabulary[c + end] for c in chars], np.int32)
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        left = np.array([vocabulary[a] for a, _ in pairs], np.int32)
        right = np.array([vocabulary[b] for _, b in pairs], np.int32)
        if max(vocabulary.values()) >= 0xFFFF or len(pairs) > SLOTS // 2:
            raise ValueError("more symbols or pairs than the table holds")
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int32)
        self._file(self._keys(left, right))

    def _file(self, keys: np.ndarray) -> None:
        """Open addressing: each rank in the first free slot from its hash on."""
        self.keys, self.ranks = np.full(SLOTS, FREE, np.uint32), np.full(SLOTS, NONE, np.int32)
        waiting, at = np.arange(len(keys)), self._slot(keys)
        while len(waiting):
            free = self.keys[at] == FREE
            # of several for one slot the first is filed
            slots, first = np.unique(at[free], return_index=True)
            filed = waiting[free][first]
            self.keys[slots], self.ranks[slots] = keys[filed], filed
            left = ~np.isin(waiting, filed)
            waiting, at = waiting[left], (at[left] + 1) & (SLOTS - 1)

    @staticmethod
    def _keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.view(np.uint32) << np.uint32(16) | right.view(np.uint32)

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint32(0x9E3779B1) >> np.uint32(32 - SLOT_BITS)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; ``NONE`` for those that are not in the table."""
        keys = self._keys(np.ascontiguousarray(left), np.ascontiguousarray(right)).ravel()
        at = self._slot(keys)
        held, found = self.keys[at], self.ranks[at]
        other = held != keys
        found[other] = NONE
        open_ = np.flatnonzero(other & (held != FREE))
        keys, at = keys[open_], at[open_]
        while len(open_):
            at = (at + 1) & (SLOTS - 1)
            held = self.keys[at]
            hit = held == keys
            found[open_[hit]] = self.ranks[at[hit]]
            go = ~hit & (held != FREE)
            open_, keys, at = open_[go], keys[go], at[go]
        return found.reshape(left.shape)

    def merged(self, symbols: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(rows, ids) in parts: the ids of the rows of ``symbols``, those of one length together."""
        done = []
        rows, ranks = np.arange(len(symbols)), self.rank(symbols[:, :-1], symbols[:, 1:])
        while ranks.shape[1]:
            best = ranks.argmin(1)
            at = np.arange(len(best))
            rank = ranks[at, best]
            go = rank != NONE
            if not go.all():
                done.append((rows[~go], symbols[~go]))
                rows, symbols, ranks, best, rank = rows[go], symbols[go], ranks[go], best[go], rank[go]
                at = np.arange(len(best))
            if not len(rows):
                return done
            width = symbols.shape[1]
            symbols[at, best] = self.made[rank]
            kept = np.ones(symbols.shape, bool)
            kept[at, best + 1] = False
            symbols = symbols[kept].reshape(len(rows), width - 1)
            kept = np.ones(ranks.shape, bool)
            kept[at, best] = False
            ranks = ranks[kept].reshape(len(rows), width - 2)
            for side in (best - 1, best):
                own = np.flatnonzero((side >= 0) & (side < width - 2))
                ranks[own, side[own]] = self.rank(symbols[own, side[own]], symbols[own, side[own] + 1])
        done.append((rows, symbols))
        return done

    def encode(self, words: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each word, which is Latin-1 in small letters without blanks,
        apostrophes and more than ``LONGEST`` characters.

        A word falls into runs of letters, single digits and runs of other signs.
        """
        if not words:
            return []
        data = np.frombuffer((" ".join(words) + " ").encode("latin-1"), np.uint8)
        kind = KIND[data]
        inside = kind != BLANK
        new = inside & ((np.append(BLANK, kind[:-1]) != kind) | (kind == DIGIT))
        ids, sizes = self.encode_runs(data[inside], (np.cumsum(inside) - 1)[new])
        # the run in which each word begins and ends
        before = np.cumsum(new)[np.flatnonzero(~inside)]
        cuts = np.append(0, np.cumsum(sizes))[before]
        packed = ids.astype("<u4").tobytes()
        cuts = (np.append(0, cuts) * 4).tolist()
        return [packed[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode_runs(self, data: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of runs one after the other, and how many each has.

        The runs are in ``data`` (Latin-1, small letters) without a gap, and begin at ``start``.
        """
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        # signs beyond ASCII have two bytes in UTF-8
        wide = data >= 0x80
        at = np.cumsum(1 + wide) - (1 + wide)
        size = int(at[-1]) + 1 + int(wide[-1])
        symbols = np.zeros(size, np.uint8)
        symbols[at] = np.where(wide, 0xC0 | data >> 6, data)
        symbols[at[wide] + 1] = 0x80 | data[wide] & 0x3F
        start = at[start]
        length = np.diff(np.append(start, size))
        ids = np.zeros(size, np.int32)
        sizes = np.zeros(len(start), np.int64)
        parts = []
        widths = -(-length // TOGETHER) * TOGETHER
        symbols = np.append(symbols, np.zeros(TOGETHER, np.uint8))
        for width in np.unique(widths):
            own = np.flatnonzero(widths == width)
            rows = symbols[start[own][:, None] + np.arange(width)]
            table = self.inner[rows]
            last = np.arange(len(own)), length[own] - 1
            table[last] = self.last[rows[last]]
            table[np.arange(width) >= length[own][:, None]] = PAD
            for which, found in self.merged(table):
                real = found != PAD
                sizes[own[which]] = real.sum(1)
                parts.append((own[which], found, real))
        ends = np.cumsum(sizes)
        for which, found, real in parts:
            at = (ends - sizes)[which][:, None] + np.arange(found.shape[1])
            ids[at[real]] = found[real]
        return ids[: ends[-1]], sizes
