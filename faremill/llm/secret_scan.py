"""Secret scans: fixed patterns, and a token-efficiency test for random strings.

A vocabulary learned from text has long entries for what people write, and none for random
characters: words take three to six characters a token, random strings between one and two.
Runs of letters, digits and ``+/=_-`` that are this inefficient under a tiktoken vocabulary are
reported, unless they are known digests, numbers, UUIDs or identifiers made of words.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import whole

TOKENIZER = "byte_bpe_50k.tiktoken"
# a random string has at least so many characters, and at most so many a token
LEAST_CHARS = 20
MOST_RATIO = 2.0
# longer runs are encoded in pieces of this size, so that their cost stays linear
PIECE = 512

# The patterns of the three base kinds, each with the length a match needs.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_CHARS = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")

RUN = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{20,}")
EDGES = "+/=_-"
# lengths of hexadecimal digests (MD5, SHA-1, SHA-2) and of SHA-2 ones in base64
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)")
DIGEST_CHARS = frozenset({32, 40, 56, 64, 96, 128})
INTEGRITY = re.compile(r"sha(?:256|384|512)-[A-Za-z0-9+/]+")
UUID = re.compile(r"[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}")
NUMBER = re.compile(r"[0-9+/=_-]+")
# the words and numbers of an identifier are this long on average, those of random strings two
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
PART_CHARS = 4


class Span(NamedTuple):
    """Code points from ``start`` to before ``end``; ``ratio`` is characters a token."""

    kind: str
    start: int
    end: int
    ratio: float | None = None


@functools.cache
def vocabulary(path: str) -> tiktoken.Encoding:
    """One per worker process."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, leftmost and non-overlapping per kind."""
    found = [
        Span("assign", *m.span())
        for m in ASSIGN.finditer(text)
        if m.end(2) - m.start(2) >= ASSIGN_CHARS
    ]
    found += [Span("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [Span("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def is_known(run: str) -> bool:
    """Whether a run is a digest, a UUID, a number or an identifier made of words."""
    if len(run) in DIGEST_CHARS and DIGEST.fullmatch(run):
        return True
    if any(p.fullmatch(run) for p in (INTEGRITY, UUID, NUMBER)):
        return True
    parts = PART.findall(run)
    return sum(map(len, parts)) >= PART_CHARS * len(parts)


def characters_per_token(run: str, encoding: tiktoken.Encoding) -> float:
    pieces = (run[i : i + PIECE] for i in range(0, len(run), PIECE))
    return len(run) / sum(len(encoding.encode_ordinary(p)) for p in pieces)


def random_spans(
    text: str, taken: list[Span], encoding: tiktoken.Encoding, most: float = MOST_RATIO
) -> list[Span]:
    """Runs with at most ``most`` characters a token that touch no span of ``taken``.

    Signs at both ends of a run do not belong to it; what is left has ``LEAST_CHARS`` or more.
    """
    out = []
    taken = sorted(taken, key=lambda s: s.start)
    at, reach = 0, 0  # taken spans that begin before the run, and how far they reach
    for m in RUN.finditer(text):
        run = m.group().lstrip(EDGES)
        start = m.end() - len(run)
        run = run.rstrip(EDGES)
        end = start + len(run)
        while at < len(taken) and taken[at].start < end:
            reach = max(reach, taken[at].end)
            at += 1
        if reach > start or len(run) < LEAST_CHARS or is_known(run):
            continue
        ratio = characters_per_token(run, encoding)
        if ratio <= most:
            out.append(Span("random", start, end, ratio))
    return out


def find(text: str, encoding: tiktoken.Encoding, most: float = MOST_RATIO) -> list[Span]:
    """All spans of a text by start, then kind."""
    base = base_spans(text)
    return sorted(
        base + random_spans(text, base, encoding, most),
        key=lambda s: (s.start, KINDS.index(s.kind)),
    )


def written(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


FINDINGS = (
    "n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string, "
    "findings array<struct<kind: string, start: long, end: long, ratio: double>>"
)


def scan_secrets(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    most: float = MOST_RATIO,
) -> DataFrame:
    """One row per input row: the key, spans per kind, a digest of the base spans, all spans.

    ``spans`` is ``kind:start:end`` by start, then kind (assign, access, hex, random), joined by
    commas; positions are code points, the end exclusive. ``base_sha256`` is the SHA-256 of the
    same text without the random ones. ``findings`` holds the spans with the characters a token
    of random ones, NULL for the others.

    A NULL text counts as empty and has no spans; its ``base_sha256`` is that of the empty text.
    A NULL key stays NULL, repeated rows give repeated results, an empty table an empty one.
    Texts of any length are read whole, one pass a pattern; nothing is shuffled. ``tokenizer``
    names a file that every executor has.
    """

    @F.pandas_udf(FINDINGS)
    def scanned(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoding = vocabulary(public_tokenizers.path(tokenizer))
        for batch in texts:
            yield pd.DataFrame(
                [_row(find(t, encoding, most)) for t in batch],
                columns=[c.split()[0] for c in FINDINGS.split(", findings")[0].split(", ")]
                + ["findings"],
            )

    found = df.select(F.col(key).alias("_key"), whole(text).alias("_text"))
    found = found.select("_key", scanned("_text").alias("_r"))
    return found.select(F.col("_key").alias(key), "_r.*")


def _row(spans: list[Span]) -> tuple:
    counts = [sum(s.kind == k for s in spans) for k in KINDS]
    base = written([s for s in spans if s.kind != "random"])
    digest = hashlib.sha256(base.encode()).hexdigest()
    return (*counts, digest, written(spans), [s._asdict() for s in spans])
