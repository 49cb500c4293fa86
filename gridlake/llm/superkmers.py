"""Words of texts as super-k-mers: runs of consecutive windows that share a minimiser, all in numpy.

A window is ``WINDOW`` consecutive words of one document. Its minimiser is the smallest hash of the pairs of adjacent words
in it, so that equal windows have the same one wherever they are, and neighbours mostly share theirs. A run of windows is one
string of their words, ``n + WINDOW - 1`` words for ``n`` windows. Runs end after ``LONGEST`` windows, so that text that
repeats itself makes no endless string.

A minimiser may be far too frequent, as that of the edge of a passage in millions of documents. Minimisers are counted in
slots; windows of a slot that is too full have their own hash instead, and are dealt one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np

from gridlake.llm.common import SPACES

WINDOW = 13
LONGEST = 64
# Bytes of text that are hashed at once; a longer document is read in overlapping pieces.
BLOCK = 1 << 20

_SPACE = re.compile(b"[" + SPACES + b"]")
_IS_SPACE = np.isin(np.arange(256), list(SPACES))
_BASE = 0x9E3779B97F4A7C15


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, and of its inverse."""
    rows = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        row = np.full(1 << bits, base, np.uint64)
        row[0] = 1
        rows.append(np.multiply.accumulate(row))
    return rows[0], rows[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """The bits of a hash spread over all of it (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(NamedTuple):
    """Words of several texts: one string with a space after each, their starts in it, and the first of each text."""

    bytes: bytes
    starts: np.ndarray
    firsts: np.ndarray

    def cut(self, first: np.ndarray, last: np.ndarray) -> list[bytes]:
        """The stretches of words from ``first`` up to ``last``, each joined by spaces."""
        whole = self.bytes
        return [whole[a:b] for a, b in zip(self.starts[first].tolist(), (self.starts[last] - 1).tolist(), strict=True)]

    def hashes(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hashes of the stretches of words from ``first`` up to ``last``."""
        n = len(self.bytes)
        power, inverse = _powers(max(1, n).bit_length())
        upto = np.zeros(n + 1, np.uint64)
        np.cumsum((np.frombuffer(self.bytes, np.uint8).astype(np.uint64) + np.uint64(1)) * power[:n], out=upto[1:])
        start = self.starts[first]
        return mixed((upto[self.starts[last] - 1] - upto[start]) * inverse[start])


def words_of(texts: list[bytes]) -> Words:
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = _IS_SPACE[raw]
    after_space = np.concatenate([[True], space[:-1]])
    kept = ~(space & after_space)
    begins = np.flatnonzero(~space & after_space)
    place = np.cumsum(kept)
    joined = np.where(space, np.uint8(32), raw)[kept]
    starts = np.append(place[begins] - 1, len(joined))
    ends = np.cumsum([len(t) + 1 for t in texts])
    firsts = np.searchsorted(begins, np.concatenate([[0], ends]))
    return Words(joined.tobytes(), starts, firsts)


def pieces(text: bytes) -> Iterator[tuple[int, bytes]]:
    """A text in pieces of about ``BLOCK`` bytes that share ``WINDOW - 1`` words, each with the number of its first word."""
    at, size = 0, BLOCK
    while len(text) > size and (cut := _SPACE.search(text, size)):
        words = text[: cut.start()].split()
        if len(words) < WINDOW:
            size *= 2
            continue
        yield at, text[: cut.start()]
        at += len(words) - (WINDOW - 1)
        text, size = b" ".join(words[1 - WINDOW :]) + text[cut.start() :], BLOCK
    yield at, text


class Runs(NamedTuple):
    """Super-k-mers: first word, number of windows, key they are dealt by, and number of the text."""

    first: np.ndarray
    size: np.ndarray
    key: np.ndarray
    text: np.ndarray

    def strings(self, words: Words) -> list[bytes]:
        return words.cut(self.first, self.first + self.size + (WINDOW - 1))


def runs_of(words: Words, slots: int = 1, crowded: np.ndarray | None = None) -> Runs:
    """The super-k-mers of all windows; those of the ``crowded`` ones among ``slots`` are dealt by their own hash."""
    n = len(words.starts) - 1
    none = np.zeros(0, np.int64)
    if n < WINDOW:
        return Runs(none, none, none.astype(np.uint64), none)
    every = np.arange(n)
    single = words.hashes(every, every + 1)
    pairs = mixed(single[:-1] * np.uint64(3) + single[1:])
    least = _least(pairs, WINDOW - 1)
    text = np.repeat(np.arange(len(words.firsts) - 1), np.diff(words.firsts))
    windows = np.flatnonzero(text[: n - WINDOW + 1] == text[WINDOW - 1 :])
    key = least[windows]
    if crowded is not None and len(crowded):
        alone = np.isin(key % np.uint64(slots), crowded)
        key[alone] = words.hashes(windows[alone], windows[alone] + WINDOW)
    if not len(windows):
        return Runs(none, none, none.astype(np.uint64), none)
    new = np.concatenate([[True], (np.diff(windows) != 1) | (key[1:] != key[:-1])])
    begins = np.flatnonzero(new)
    inside = np.arange(len(windows)) - np.repeat(begins, np.diff(np.append(begins, len(windows))))
    begins = np.flatnonzero(inside % LONGEST == 0)
    first = windows[begins]
    return Runs(first, np.diff(np.append(begins, len(windows))), key[begins], text[first])


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, by doubling."""
    held, have = x, 1
    while have * 2 <= width:
        held = np.minimum(held[: len(held) - have], held[have:])
        have *= 2
    rest = width - have
    return np.minimum(held[: len(held) - rest], held[rest:]) if rest else held
