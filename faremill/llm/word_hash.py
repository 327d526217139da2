"""Words of a text and their 64-bit hashes, computed on its UTF-8 bytes at once.

A word is a run of letters, marks and digits (Unicode's classes L, M and N), in lower case; all
else divides words, also beyond ASCII: spaces, punctuation, symbols, controls. Scripts that are
written without spaces (``ALONE``) have a word per letter, with the marks after it.
The hash of a span is a polynomial over its bytes modulo 2**64, taken from prefix sums, so the
cost is a few array operations for a text of any length.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(0x5EED).integers(1, 1 << 63, 256, np.uint64)
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*b"abcdefghijklmnopqrstuvwxyz0123456789"]] = True

# letters of these are words of their own, by the beginnings of their names
ALONE = ("CJK ", "HIRAGANA ", "KATAKANA", "HALFWIDTH KATAKANA", "THAI ", "LAO ", "KHMER ", "MYANMAR ")
_NONE, _LETTER, _ALONE, _MARK = range(4)
_SELECTORS = (*range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0))  # marks that stand after symbols


@functools.cache
def _kinds() -> np.ndarray:
    """What each code point is to a word."""
    kinds = np.zeros(0x110000, np.int8)
    for point in range(0x110000):
        sign = chr(point)
        category = unicodedata.category(sign)
        if category[0] == "M":
            kinds[point] = _MARK
        elif category[0] in "LN":
            alone = category[0] == "L" and unicodedata.name(sign, "").startswith(ALONE)
            kinds[point] = _ALONE if alone else _LETTER
    kinds[list(_SELECTORS)] = _NONE
    return kinds


def _edges(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text, in bytes of its UTF-8."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    kinds = _kinds()[points]
    inside = np.zeros(len(kinds) + 2, bool)
    inside[1:-1] = kinds != _NONE
    # what the marks before a place stand on
    base = np.maximum.accumulate(np.where(kinds != _MARK, np.arange(len(kinds)), 0))
    before = np.concatenate([[_NONE], kinds[base[:-1]]])
    begins = (kinds == _ALONE) | ((kinds == _LETTER) & (before == _ALONE))
    starts = inside[1:-1] & (~inside[:-2] | begins)
    ends = inside[:-1] & ~inside[1:]
    ends[:-1] |= inside[:-2] & starts
    sizes = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    places = np.concatenate([[0], np.cumsum(sizes)])
    return places[np.flatnonzero(starts)], places[np.flatnonzero(ends)]


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


class _Powers:
    """Powers of the base and of its inverse, as long as the longest text so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if n > len(self.up):
            n += n // 4
            self.up, self.down = _powers(BASE, n), _powers(_INVERSE, n)


_POWERS = _Powers()


class Spans:
    """Hashes of spans of code points."""

    def __init__(self, points: np.ndarray) -> None:
        _POWERS.reach(len(points) + 1)
        self._sums = np.zeros(len(points) + 1, np.uint64)
        spread = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        spread ^= spread >> np.uint64(32)
        np.cumsum(spread * _POWERS.up[: len(points)], out=self._sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * _POWERS.down[starts])


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """The words of a text; ``len()`` of them, in order."""

    def __init__(self, text: str) -> None:
        text = text.lower()
        data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        if len(data) == len(text):
            inside = np.zeros(len(data) + 2, np.int8)
            inside[1:-1] = _IS_WORD[data]
            edges = np.diff(inside)
            self.starts, self.ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        else:
            self.starts, self.ends = _edges(text)
        _POWERS.reach(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * _POWERS.up[: len(data)], out=self._sums[1:])

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        return self._spans(self.ends)

    def prefixes(self, length: int) -> np.ndarray:
        """Hashes of the first ``length`` bytes, of all of a shorter word."""
        return self._spans(np.minimum(self.starts + length, self.ends))

    def _spans(self, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[self.starts]) * _POWERS.down[self.starts])


def word_hashes(text: str) -> np.ndarray:
    """The hash of every word, in order; empty for a text without words."""
    return Words(text).hashes()
