from __future__ import annotations

import random

# extra columns are called like results and like internal names
DOCS = "doc_id long, text string, kept string, n_tokens string, score string, key string, id int"
LONG = " ".join(f"word{i % 977} and, the {i}" for i in range(60_000))


def edge_documents(spark):
    """NULL keys and texts, empty, blank and very long texts, repeated rows, odd characters."""
    rows = [
        (1, "alpha beta gamma delta epsilon zeta"),
        (2, "alpha beta gamma\tdelta  epsilon zeta"),
        (3, ""),
        (4, None),
        (5, "   \n\t "),
        (6, LONG),
        (7, "日本語 текст ﬀ 🙂 it's  x <|endoftext|> don't'll"),
        (8, "one"),
        (8, "one"),
        (9, "alpha beta gamma delta epsilon zeta"),
        (None, "alpha beta gamma delta epsilon zeta"),
        (None, None),
        (-5, "same words again and again and again"),
        (10, "!!! ???"),
        (11, "??? !!!"),
        (12, "ab\u0000cd   \x85 z"),
    ]
    return spark.createDataFrame([(*r, "x", "y", "z", "k", 1) for r in rows], DOCS)


def empty_documents(spark):
    return spark.createDataFrame([], DOCS)


def words(rng: random.Random, n: int) -> list[str]:
    return [f"w{rng.randrange(4000)}" for _ in range(n)]
