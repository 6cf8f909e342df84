"""Suffix order of a block of bytes by two-stage sorting, with numpy.

Only suffixes that are smaller than their successor are sorted directly; a scan over the
buckets of first bytes puts each other suffix behind the one that starts a byte later.
The order holds for the first ``DEPTH`` bytes; suffixes that agree on them come in any order.
"""

from __future__ import annotations

import numpy as np

DEPTH = 104  # of the direct comparison: whole words of 8 bytes


def word_keys(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number; zeros beyond the end."""
    padded = np.concatenate([data, np.zeros(DEPTH + 8, np.uint8)]).astype(np.uint64)
    keys = np.zeros(len(data) + DEPTH, np.uint64)
    for i in range(8):
        keys |= padded[i : i + len(keys)] << np.uint64(56 - 8 * i)
    return keys


def rises(data: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; the last one is not."""
    n = len(data)
    change = np.empty(n, np.int64)
    change[-1] = n - 1
    differs = np.flatnonzero(data[:-1] != data[1:])
    change[:-1] = np.append(differs, n - 1)[np.searchsorted(differs, np.arange(n - 1))]
    follow = np.append(data, np.uint8(0))
    return (data[change] < follow[change + 1]) & (change < n - 1)


def sorted_directly(places: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """``places`` in the order of their suffixes, word by word where they still agree."""
    order = places[np.argsort(keys[places], kind="stable")]
    word = keys[order]
    group = np.cumsum(np.concatenate([[0], (word[1:] != word[:-1]).astype(np.int64)]))
    for at in range(8, DEPTH, 8):
        same = np.concatenate([[False], group[1:] == group[:-1]])
        tied = np.flatnonzero(same | np.append(same[1:], False))
        if not len(tied):
            break
        word, own = keys[order[tied] + at], group[tied]
        inner = np.lexsort((word, own))
        order[tied], word, own = order[tied[inner]], word[inner], own[inner]
        # groups keep their first place as number, so that others need not be counted anew
        new = np.concatenate([[True], (own[1:] != own[:-1]) | (word[1:] != word[:-1])])
        group[tied] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
        loose = np.ones(len(order), bool)
        loose[tied] = False
        group[loose] = np.flatnonzero(loose)
    return order


def suffix_order(data: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """All places of ``data`` in the order of their suffixes."""
    if not len(data):
        return np.zeros(0, np.int64)
    rise = rises(data)
    direct = np.flatnonzero(rise)
    direct = sorted_directly(direct, keys) if len(direct) else direct
    bounds = np.searchsorted(data[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[data[-1]].append(np.array([len(data) - 1]))
    out = []

    def induce(scanned: np.ndarray, byte: int) -> np.ndarray:
        """Predecessors that fall, in scan order: those of this bucket; others wait."""
        before = scanned[scanned > 0] - 1
        before = before[~rise[before]]
        first = data[before]
        later = before[first != byte]
        if len(later):
            first = data[later]
            by_byte = np.argsort(first, kind="stable")
            later, first = later[by_byte], first[by_byte]
            cuts = np.flatnonzero(first[1:] != first[:-1]) + 1
            for part in np.split(later, cuts):
                waiting[data[part[0]]].append(part)
        return before[data[before] == byte]

    for byte in range(256):
        wave = np.concatenate(waiting[byte]) if waiting[byte] else np.zeros(0, np.int64)
        waiting[byte] = []
        while len(wave):
            out.append(wave)
            wave = induce(wave, byte)
        own = direct[bounds[byte] : bounds[byte + 1]]
        if len(own):
            out.append(own)
            induce(own, byte)
    return np.concatenate(out)


def common_prefixes(order: np.ndarray, keys: np.ndarray, most: int) -> np.ndarray:
    """Bytes that each place of ``order`` shares with the one before it, up to ``most``."""
    shared = np.zeros(len(order), np.int64)
    if len(order) < 2:
        return shared
    open_ = np.arange(1, len(order))
    for at in range(0, most, 8):
        differ = keys[order[open_] + at] ^ keys[order[open_ - 1] + at]
        # leading equal bytes of two words
        bits = np.frexp((differ >> np.uint64(11)).astype(np.float64))[1] + 11
        low = differ >> np.uint64(11) == 0
        bits[low] = np.frexp(differ[low].astype(np.float64))[1]
        shared[open_] += (64 - bits) // 8
        open_ = open_[differ == 0]
    return np.minimum(shared, most)
