"""Words of texts as hashes: whole batches of texts at once, with numpy.

A word is a run of bytes other than the blank and the ASCII controls 9 to 13, so words of the
UTF-8 bytes are those of the text. Texts are worked on in pieces of bounded size, cut at blanks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
BYTE_STEP = 0x9E3779B97F4A7C15
BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser; wraps round."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(step: int, n: int) -> np.ndarray:
    found = np.full(n, step, np.uint64)
    found[:1] = 1
    return np.cumprod(found, dtype=np.uint64)


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of ``data``."""
    inside = np.concatenate([[False], ~BLANK[data], [False]])
    change = np.flatnonzero(inside[1:] != inside[:-1])
    return change[::2], change[1::2]


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of each word, from running sums; arithmetic is modulo 2^64."""
    powers = _powers(BYTE_STEP, len(data))
    back = _powers(pow(BYTE_STEP, -1, 1 << 64), len(data))
    sums = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers, dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), sums])
    return mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def cut(data: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Pieces (start, end) of about ``size``, each ending behind a blank or at the end."""
    at = 0
    while at < len(data):
        end, reach = at + size, size
        while end < len(data):
            blank = np.flatnonzero(BLANK[data[end - reach : end]])
            if len(blank):
                end += int(blank[-1]) + 1 - reach
                break
            end += reach  # a word longer than the piece
        yield at, min(end, len(data))
        at = min(end, len(data))


def word_hashes(text: bytes) -> np.ndarray:
    """Hash of every word of a text."""
    data = np.frombuffer(text, np.uint8)
    found = [np.zeros(0, np.uint64)]
    for start, end in cut(data):
        piece = data[start:end]
        found.append(_hashes(piece, *word_bounds(piece)))
    return np.concatenate(found)


def word_count(text: bytes) -> int:
    """Number of words of a text."""
    data = np.frombuffer(text, np.uint8)
    return sum(len(word_bounds(data[start:end])[0]) for start, end in cut(data))


def hashed_texts(texts: pa.Array) -> Iterator[tuple[int, list[int], np.ndarray]]:
    """(number of the first text, words of each text, hashes of all their words), some texts at
    a time; a null text has no words."""
    first, held, size = 0, [], 0
    for number, text in enumerate(texts):
        held.append((text.as_py() or "").encode())
        size += len(held[-1])
        if size >= PIECE:
            yield first, *_together(held)
            first, held, size = number + 1, [], 0
    if held:
        yield first, *_together(held)


def _together(texts: list[bytes]) -> tuple[list[int], np.ndarray]:
    if len(texts) == 1:
        found = word_hashes(texts[0])
        return [len(found)], found
    data = np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8)
    ends_of = np.cumsum([len(t) + 1 for t in texts])
    counts, found = np.zeros(len(texts), np.int64), [np.zeros(0, np.uint64)]
    for start, end in cut(data):
        piece = data[start:end]
        starts, ends = word_bounds(piece)
        found.append(_hashes(piece, starts, ends))
        owner = np.searchsorted(ends_of, starts + start, side="right")
        counts += np.bincount(owner, minlength=len(texts))
    return counts.tolist(), np.concatenate(found)


def rolled(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words."""
    step = np.uint64(0xD6E8FEB86659FD93)
    size = max(len(hashes) - n + 1, 0)
    found = np.zeros(size, np.uint64)
    for i in range(n):
        found = found * step + hashes[i : i + size]
    return mixed(found ^ np.uint64(n))
