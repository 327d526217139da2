"""Hashed row keys. Pass doubles as decimals: their text form is not stable."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TEXT = "_null_"


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over dash-separated parts; a NULL part counts as a fixed word: the key is never NULL."""
    parts = [F.coalesce(_text(c), F.lit(NULL_TEXT)) for c in cols]
    return F.md5(F.concat_ws("-", *parts).cast("binary"))


def row_id(*cols: Column | str) -> Column:
    """md5 over the parts without a separator; NULL as soon as one part is NULL."""
    return F.md5(F.concat(*[_text(c) for c in cols]).cast("binary"))
