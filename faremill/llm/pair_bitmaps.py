"""Compressed sets of documents for pairs, with bit planes for how often each document holds them.

Documents are numbered within a chunk of at most 65,536. A plane holds for every pair the
documents in whose count of the pair that bit is set: the union of a pair's planes are its
documents, and the sizes of the planes, each times its power of two, add up to its occurrences.
A pair's set is a sorted array of numbers or a bitmap, whichever is smaller.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

DOCUMENT_BITS = 16
DOCUMENTS = 1 << DOCUMENT_BITS


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of a sorted array, and how often each occurs."""
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])[: len(values)])
    return values[first], np.diff(np.append(first, len(values)))


@dataclass
class Sets:
    """Sets of documents by pair: pairs with an array of documents, and pairs with a bitmap."""

    documents: int
    sparse: np.ndarray  # pairs, ascending
    sizes: np.ndarray
    numbers: np.ndarray  # documents, set after set
    dense: np.ndarray  # pairs, ascending
    bits: np.ndarray  # one row a pair

    @classmethod
    def of(cls, keys: np.ndarray, documents: int) -> Sets:
        """From distinct sorted keys, ``pair << 16 | document``."""
        pairs, sizes = runs(keys >> DOCUMENT_BITS)
        numbers = (keys & (DOCUMENTS - 1)).astype(np.uint16)
        width = -(-documents // 8)
        many = sizes * 2 > width
        each = np.repeat(many, sizes)
        full = np.zeros((int(many.sum()), width * 8), bool)
        full[np.repeat(np.arange(len(full)), sizes[many]), numbers[each]] = True
        bits = np.packbits(full, axis=1, bitorder="little")
        return cls(documents, pairs[~many], sizes[~many], numbers[~each], pairs[many], bits)

    def keys(self) -> np.ndarray:
        """Sorted keys, of which ``of`` makes the same sets."""
        arrays = np.repeat(self.sparse, self.sizes) << DOCUMENT_BITS | self.numbers
        row, number = np.nonzero(np.unpackbits(self.bits, axis=1, bitorder="little"))
        bitmaps = self.dense[row] << DOCUMENT_BITS | number
        return np.sort(np.concatenate([arrays, bitmaps]).astype(np.int64))

    @classmethod
    def union(cls, parts: list[Sets], documents: int) -> Sets:
        """OR of sets; a document in several of them counts once."""
        keys = np.concatenate([np.empty(0, np.int64), *(p.keys() for p in parts)])
        # runs of sorted keys, which a stable sort merges
        return cls.of(runs(np.sort(keys, kind="stable"))[0], documents)

    def popcount(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs, ascending, and the sizes of their sets."""
        pairs = np.concatenate([self.sparse, self.dense])
        ones = np.bitwise_count(self.bits).sum(axis=1, dtype=np.int64)
        sizes = np.concatenate([self.sizes, ones])
        order = np.argsort(pairs)
        return pairs[order], sizes[order]

    def encode(self, pairs: np.ndarray) -> bytes:
        """Bytes, with pairs as places in ``pairs``."""
        arrays = [
            np.searchsorted(pairs, self.sparse).astype("<u4"),
            self.sizes.astype("<u2"),
            self.numbers.astype("<u2"),
            np.searchsorted(pairs, self.dense).astype("<u4"),
            self.bits,
        ]
        head = struct.pack("<IIII", self.documents, *(len(arrays[i]) for i in (0, 2, 3)))
        return head + b"".join(a.tobytes() for a in arrays)

    @classmethod
    def decode(cls, data: memoryview, pairs: np.ndarray) -> Sets:
        documents, sparse, numbers, dense = struct.unpack_from("<IIII", data)
        at = 16

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, count, at)
            at += found.nbytes
            return found

        where, sizes, held = take("<u4", sparse), take("<u2", sparse), take("<u2", numbers)
        width = -(-documents // 8)
        full, bits = take("<u4", dense), take("u1", dense * width).reshape(dense, width)
        return cls(documents, pairs[where], sizes.astype(np.int64), held, pairs[full], bits)


@dataclass
class Postings:
    """The planes of some documents."""

    planes: list[Sets]

    @classmethod
    def of(cls, keys: np.ndarray, times: np.ndarray, documents: int) -> Postings:
        """From distinct sorted keys and how often each occurs."""
        most = int(times.max(initial=0)).bit_length()
        return cls([Sets.of(keys[times >> k & 1 == 1], documents) for k in range(most)])

    @classmethod
    def merged(cls, parts: list[Postings], documents: int) -> Postings:
        """Planes of parts with documents of their own."""
        most = max((len(p.planes) for p in parts), default=0)
        each = ([p.planes[k] for p in parts if k < len(p.planes)] for k in range(most))
        return cls([Sets.union(some, documents) for some in each])

    def counts(self, documents: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs, ascending, their documents and their occurrences."""
        pairs, held = Sets.union(self.planes, documents).popcount()
        times = np.zeros(len(pairs), np.int64)
        for k, plane in enumerate(self.planes):
            some, sizes = plane.popcount()
            times[np.searchsorted(pairs, some)] += sizes << k
        return pairs, held, times

    def encode(self, pairs: np.ndarray) -> bytes:
        parts = [p.encode(pairs) for p in self.planes]
        return b"".join(struct.pack("<I", len(p)) + p for p in parts)

    @classmethod
    def decode(cls, data: bytes, pairs: np.ndarray) -> Postings:
        view, at, planes = memoryview(data), 0, []
        while at < len(view):
            (size,) = struct.unpack_from("<I", view, at)
            planes.append(Sets.decode(view[at + 4 : at + 4 + size], pairs))
            at += 4 + size
        return cls(planes)

    def sums(self, pairs: np.ndarray, values: np.ndarray, documents: int) -> np.ndarray:
        """For every document the sum of ``values`` (of ``pairs``) over its occurrences."""
        out = np.zeros(documents, np.int64)
        for k, plane in enumerate(self.planes):
            keys = plane.keys()
            worth = values[np.searchsorted(pairs, keys >> DOCUMENT_BITS)] << k
            np.add.at(out, keys & (DOCUMENTS - 1), worth)
        return out
