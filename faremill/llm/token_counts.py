"""Token counts with the whole-token shortcut.

Most pre-tokens of a text are single tokens of the vocabulary. Which strings those are is
proven beforehand: a vocabulary entry that is one pre-token and that the library encodes alone
as one token counts one wherever it stands, since merges never cross pre-tokens. Only the
other pre-tokens are merged, each distinct one once per worker while it is remembered.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm import byte_bpe
from faremill.llm.common import whole

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024


class TokenCounter:
    def __init__(self, path: str, memo: int = byte_bpe.MEMO) -> None:
        self.bpe = byte_bpe.ByteBpe(path, memo)
        self.whole = self._prove()
        self.table = byte_bpe.Memo()
        known = byte_bpe.PreTokens(sorted(self.whole))
        self.table.add(known, np.arange(len(known.hashes)), [b""] * len(known.hashes))

    def _prove(self) -> frozenset[str]:
        """Vocabulary strings that are one pre-token and that encode alone as one token."""
        library = self.bpe.library
        strings = {library.decode([i]) for i in range(library.get_vocab_size())}
        single = [s for s in strings if self.bpe.splits(s)]
        single = [s for s in single if byte_bpe.PRE_TOKEN.findall(s) == [s]]
        counts = map(len, self.bpe.encode_whole(single))
        return frozenset(s for s, n in zip(single, counts, strict=True) if n == 1)

    def counts(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        split = [i for i, text in enumerate(texts) if self.bpe.splits(text)]
        for i in set(range(len(texts))) - set(split):
            out[i] = len(self.bpe.encode_whole([texts[i]])[0])
        for owners, pieces in byte_bpe.batched([(i, texts[i]) for i in split]):
            np.add.at(out, owners, self._counts(pieces))
        return out

    def _counts(self, texts: list[str]) -> np.ndarray:
        try:
            found = byte_bpe.PreTokens(texts)
            each = np.ones(len(found.hashes), np.int64)
            rest = np.flatnonzero(self.table.find(found) < 0)  # not whole tokens
            each[rest] = self.bpe.memo_sizes(found.only(rest))
        except byte_bpe.HashClash:
            return np.array([len(ids) for ids in self.bpe.encode_whole(texts)], np.int64)
        return np.diff(np.concatenate([[0], np.cumsum(each[found.which])])[found.bounds])


@functools.cache
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def count_tokens(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    limit: int = LIMIT,
) -> DataFrame:
    """One row per input row: the key, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``.

    A NULL text counts as empty: 0 bytes, 0 tokens. A NULL key stays NULL, repeated rows give
    repeated results, an empty table an empty one. Texts of any length are counted whole.
    Nothing is shuffled. ``tokenizer`` names a file that every executor has; its place is
    looked up there.
    """

    @F.pandas_udf("long")
    def tokens(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counts = counter(public_tokenizers.path(tokenizer)).counts
        for batch in texts:
            yield pd.Series(counts(batch.to_list()), dtype="int64")

    counted = df.select(F.col(key).alias("_key"), whole(text).alias("_text"))
    counted = counted.withColumn("_n", tokens("_text"))
    return counted.select(
        F.col("_key").alias(key),
        F.octet_length("_text").cast("long").alias("n_bytes"),
        F.col("_n").alias("n_tokens"),
        (F.col("_n") > limit).alias("over_limit"),
    )
