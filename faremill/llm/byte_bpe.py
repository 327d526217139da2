"""Byte-level BPE through a memo of pre-tokens.

Merges never cross a pre-token, and a pre-token that stands alone is split off as itself, so
the ids of a text are the ids of its pre-tokens one after the other. Words repeat, so a memo
in front of the library spares most of its work. Texts for which this is not proven go to the
library whole: those that hold the string of an added token, and those with a character
outside the ranges below, whose class is the same in every Unicode version in use.

Pre-tokens are found for many texts at once, by array operations on their code points. Equal
ones of a batch are brought together by a 64-bit hash; the memo compares the characters too.
"""

from __future__ import annotations

import copy
import functools
import os
import re
import struct
from collections.abc import Iterator

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
os.environ.setdefault("RAYON_NUM_THREADS", "1")

from tokenizers import Tokenizer  # noqa: E402

from faremill.llm.word_hash import Spans  # noqa: E402

# Characters by the class that the byte-level pre-tokenizer puts them in.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ʯЀ-ҁҊ-ԯ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = "\t-\r \u0085 "
OTHERS = (
    "\x00-\x08\x0e-\x1f!-/:-@\\[-`{-\u0084\u0086-\u009f¡-©«-±´"
    "¶-¸»¿×÷‐-‧‰-⁞₠-₿"
)
# The contractions of the pre-tokenizer.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"

PRE_TOKEN = re.compile(
    f"{CONTRACTIONS}| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[{OTHERS}]+"
    f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
SPACE, LETTER, NUMBER, OTHER, END = range(5)
BETWEEN = "\U0010ffff"  # ends a text of a batch; unproven, so never inside one
KNOWN = 0x20C0  # proven characters are below
CUT = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")  # a pre-token begins at the space
BATCH_CHARS = 1 << 19
UNPROVEN = re.compile(f"[^{LETTERS}{NUMBERS}{SPACES}{OTHERS}]")
# words after a space may be joined to one text, which splits into the same words again
JOINED = 500
CALL_WORDS = 10_000

# pre-tokens that a worker remembers; then it starts anew
MEMO = 700_000


class Memo:
    """Ids of pre-tokens by hash, in flat arrays that take little more room than the ids."""

    def __init__(self) -> None:
        self.hashes = np.empty(0, np.uint64)  # ascending
        self.row = np.empty(0, np.int64)  # of each hash
        self.ids = Flat("<u4")
        self.characters = Flat("<u2")  # proven characters have two bytes

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, found: PreTokens) -> np.ndarray:
        """The row of each distinct pre-token, -1 if it is not known."""
        if not len(self):
            return np.full(len(found.hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, found.hashes), len(self) - 1)
        row = np.where(self.hashes[at] == found.hashes, self.row[at], -1)
        known = np.flatnonzero(row >= 0)
        own, _ = found.characters(known)
        kept, sizes = self.characters.take(row[known])
        same_size = sizes == found.ends[known] - found.starts[known]
        if not same_size.all() or (own != kept).any():  # a hash that two pre-tokens share
            raise HashClash
        return row

    def add(self, found: PreTokens, new: np.ndarray, ids: list[bytes]) -> None:
        characters, sizes = found.characters(new)
        first = self.characters.add(characters, sizes)
        sizes = np.array([len(x) // 4 for x in ids], np.int64)
        self.ids.add(np.frombuffer(b"".join(ids), "<u4"), sizes)
        order = np.argsort(found.hashes[new])
        at = np.searchsorted(self.hashes, found.hashes[new][order])
        self.hashes = np.insert(self.hashes, at, found.hashes[new][order])
        self.row = np.insert(self.row, at, first + order)


class HashClash(Exception):
    """Two pre-tokens with one hash; the texts are then encoded by the library."""


class Flat:
    """Rows of numbers one after the other, in an array that grows by doubling."""

    def __init__(self, kind: str) -> None:
        self.data, self.used = np.empty(1 << 16, kind), 0
        self.bounds, self.rows = np.zeros(1 << 14, np.int64), 0

    def add(self, data: np.ndarray, sizes: np.ndarray) -> int:
        """Append rows of these sizes; the number of the first."""
        while self.used + len(data) > len(self.data):
            self.data = np.concatenate([self.data, np.empty_like(self.data)])
        while self.rows + len(sizes) + 1 > len(self.bounds):
            self.bounds = np.concatenate([self.bounds, np.empty_like(self.bounds)])
        self.data[self.used : self.used + len(data)] = data
        ends = self.used + np.cumsum(sizes)
        self.bounds[self.rows + 1 : self.rows + 1 + len(sizes)] = ends
        first = self.rows
        self.used += len(data)
        self.rows += len(sizes)
        return first

    def sizes(self, rows: np.ndarray) -> np.ndarray:
        return self.bounds[rows + 1] - self.bounds[rows]

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """These rows one after the other, and their sizes."""
        starts = self.bounds[rows]
        sizes = self.bounds[rows + 1] - starts
        return self.data[along(starts, sizes)], sizes


def along(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of spans, span after span."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(total)


class ByteBpe:
    """Ids of texts as the ``tokenizers`` library gives them for the file at ``path``.

    No begin, end or other added special tokens, no truncation and no padding; the string of a
    special token inside a text is that token, the library's default.
    """

    def __init__(self, path: str, memo: int = MEMO) -> None:
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.most = memo
        self.memo = Memo()
        # bytes of each token: the vocabulary writes a byte as one character
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.lengths[i] = len(token)

    def splits(self, text: str) -> bool:
        """Whether the text may be cut into pre-tokens here."""
        return not (self.added and self.added.search(text)) and not UNPROVEN.search(text)

    def encode_whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each pre-token; words after a space are encoded many to a call.

        Where one of them ends among the ids of all is told by the tokens' lengths in bytes.
        """
        out: dict[str, bytes] = {}
        spaced = [w for w in words if w[0] == " " and w[1:].isalpha()]
        alone = [w for w in words if not (w[0] == " " and w[1:].isalpha())]
        for at in range(0, len(spaced), CALL_WORDS):
            part = spaced[at : at + CALL_WORDS]
            texts = ["".join(part[i : i + JOINED]) for i in range(0, len(part), JOINED)]
            found = self.library.encode_batch_fast(texts, add_special_tokens=False)
            ids = np.concatenate([np.array(e.ids, "<u4") for e in found])
            behind = np.cumsum(self.lengths[ids])
            sizes = np.cumsum([len(w.encode()) for w in part])
            cuts = np.searchsorted(behind, sizes) + 1
            if (behind[cuts - 1] != sizes).any():  # cannot be: merges never cross words
                raise RuntimeError("a token crosses words")
            cuts = [0, *(4 * cuts).tolist()]
            data = ids.tobytes()
            out.update(zip(part, (data[i:j] for i, j in zip(cuts, cuts[1:])), strict=True))
        for at in range(0, len(alone), CALL_WORDS):
            part = alone[at : at + CALL_WORDS]
            for word, ids in zip(part, self.encode_whole(part), strict=True):
                out[word] = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def rows(self, found: PreTokens) -> np.ndarray:
        """The memo's row of each distinct pre-token, which is learned if need be."""
        if len(self.memo) + len(found.hashes) > self.most:
            self.memo = Memo()
        row = self.memo.find(found)
        new = np.flatnonzero(row < 0)
        if len(new):
            words = found.words(new)
            ids = self.encode_words(words)
            first = self.memo.ids.rows
            self.memo.add(found, new, [ids[w] for w in words])
            row[new] = first + np.arange(len(new))
        return row

    def memo_sizes(self, found: PreTokens) -> np.ndarray:
        """How many tokens each distinct pre-token has."""
        row = self.rows(found)
        return self.memo.ids.sizes(row)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [i for i, text in enumerate(texts) if self.splits(text)]
        parts: list[list[bytes]] = [[] for _ in texts]
        for i in set(range(len(texts))) - set(split):
            parts[i].append(self._whole(texts[i]))
        for owners, pieces in batched([(i, texts[i]) for i in split]):
            for i, ids in zip(owners, self._ids(pieces), strict=True):
                parts[i].append(ids)
        return [b"".join(p) for p in parts]

    def _whole(self, text: str) -> bytes:
        ids = self.encode_whole([text])[0]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _ids(self, texts: list[str]) -> list[bytes]:
        try:
            found = PreTokens(texts)
            row = self.rows(found)[found.which]
        except HashClash:
            return [self._whole(t) for t in texts]
        ids, sizes = self.memo.ids.take(row)
        data = ids.tobytes()
        cuts = 4 * np.concatenate([[0], np.cumsum(sizes)])[found.bounds]
        return [data[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist())]


def batched(texts: list[tuple[int, str]]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts in batches of about ``BATCH_CHARS`` characters; a long one is cut where a
    pre-token begins, and its number then occurs more than once."""
    owners: list[int] = []
    pieces: list[str] = []
    held = 0
    for i, text in texts:
        start = 0
        while True:
            cut = CUT.search(text, start + BATCH_CHARS) if len(text) > BATCH_CHARS else None
            piece = text[start : cut.start()] if cut else text[start:]
            owners.append(i)
            pieces.append(piece)
            held += len(piece)
            if held >= BATCH_CHARS:
                yield owners, pieces
                owners, pieces, held = [], [], 0
            if not cut:
                break
            start = cut.start()
    if pieces:
        yield owners, pieces


@functools.cache
def _classes() -> np.ndarray:
    """Class by code point; beyond the proven ones that of ``BETWEEN``."""
    table = np.full(KNOWN + 1, END, np.int8)
    kinds = ((SPACE, SPACES), (LETTER, LETTERS), (NUMBER, NUMBERS), (OTHER, OTHERS))
    for kind, ranges in kinds:
        fits = re.compile(f"[{ranges}]").match
        table[[c for c in range(KNOWN) if fits(chr(c))]] = kind
    return table


class PreTokens:
    """The pre-tokens of several texts.

    The distinct ones have ``hashes`` (ascending) and stand, among other places, from
    ``starts`` to ``ends``; ``which`` tells for each pre-token in order which of them it is,
    and text ``i`` has those from ``bounds[i]`` to ``bounds[i + 1]``.
    """

    def __init__(self, texts: list[str]) -> None:
        self.joined = BETWEEN.join(texts) + 3 * BETWEEN  # a contraction looks two ahead
        self.points = points = np.frombuffer(self.joined.encode("utf-32-le"), "<u4")
        kind = _classes()[np.minimum(points, KNOWN)]
        starts = np.flatnonzero(self._starts(points, kind))
        ends = np.append(starts[1:], len(points))
        real = kind[starts] != END
        self.bounds = np.concatenate([[0], np.cumsum(real)[~real]])[: len(texts) + 1]
        starts, ends = starts[real], ends[real]
        self.hashes, first, self.which = np.unique(
            Spans(points).hashes(starts, ends), return_index=True, return_inverse=True
        )
        self.starts, self.ends = starts[first], ends[first]

    def only(self, some: np.ndarray) -> PreTokens:
        """Some of the distinct ones, without their places."""
        part = copy.copy(self)
        part.hashes = self.hashes[some]
        part.starts, part.ends = self.starts[some], self.ends[some]
        return part

    def words(self, some: np.ndarray) -> list[str]:
        spans = zip(self.starts[some].tolist(), self.ends[some].tolist(), strict=True)
        return [self.joined[a:b] for a, b in spans]

    def characters(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.ends[some] - self.starts[some]
        return self.points[along(self.starts[some], sizes)], sizes

    @staticmethod
    def _starts(points: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Where a pre-token, or the end of a text, stands."""
        before = np.concatenate([[END], kind[:-1]])
        run = (kind != SPACE) & ((kind != before) | (kind == END))
        after_space = np.concatenate([[False], points[:-1] == 32])
        # contractions: an apostrophe that begins a pre-token, and what follows
        quotes = np.flatnonzero((points == 39) & run & ~after_space)
        one, two = points[quotes + 1], points[quotes + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(quotes), bool)
        for pair in ("re", "ve", "ll"):
            long |= (one == ord(pair[0])) & (two == ord(pair[1]))
        for at, size in ((quotes[short], 2), (quotes[long], 3)):
            run[at + 1] = False
            run[at + size] |= kind[at + size] == LETTER
        blank = kind == SPACE
        # a space before a word belongs to it; so does no space before a text's end
        attached = after_space & run & (kind != END)
        last = np.zeros(len(points), bool)
        last[:-1] = blank[:-1] & ~blank[1:] & (kind[1:] != END)
        return (run & ~attached) | (blank & (before != SPACE)) | last


@functools.cache
def coder(path: str) -> ByteBpe:
    """One per worker process; Spark reuses workers, and so the memo."""
    return ByteBpe(path)
