"""JSON text to columns and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_field(col: Column | str, key: str) -> Column:
    """Text of one top-level key, also for keys such as ``@id``."""
    return F.get_json_object(F.col(col) if isinstance(col, str) else col, f"$['{key}']")


def parse_event(col: Column | str, schema: T.StructType) -> Column:
    """One pass over the JSON text for all declared fields."""
    return F.from_json(F.col(col) if isinstance(col, str) else col, schema)


def to_event(*cols: Column | str) -> Column:
    return F.to_json(F.struct(*cols))
