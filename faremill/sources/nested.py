"""Nested records as tables: one for the record, and one for every list below it, at any depth.

Each row has a key of its own that follows from its content, so that loading the same records
again gives the same keys: the record's from its key columns, a list element's from its parent's
key, the list and its place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.sources.landing import snake

ROW, PARENT, PLACE = "_row_key", "_parent_key", "_place"
VALUE = "value"
SEPARATOR = "__"


def record_key(columns: list[str]) -> Column:
    """Hash of the columns as JSON, in which no two lists of values look alike."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def _leaves(kind: T.DataType, at: Column, name: str) -> list[tuple[str, Column, T.DataType]]:
    """Fields below a value, through structs but not into lists."""
    if not isinstance(kind, T.StructType):
        return [(name, at, kind)]
    found = []
    for field in kind.fields:
        below = f"{name}{SEPARATOR}{snake(field.name)}" if name else snake(field.name)
        found += _leaves(field.dataType, at.getField(field.name), below)
    return found


def split_lists(df: DataFrame, name: str, key: list[str] | None = None) -> dict[str, DataFrame]:
    """Tables by name, the record's first.

    ``name`` has ``_row_key`` and the record's fields, structs flattened and names normalised.
    A list ``name__path`` has ``_row_key``, ``_parent_key``, ``_place`` (from 0) and the fields of
    its elements, or ``value`` for elements that are no structs; lists in lists are split in
    turn. NULL and empty lists have no rows, a NULL element has one with NULL fields. ``key`` is
    by default the whole record: equal records then share a key, and so do their elements.
    """
    tables: dict[str, DataFrame] = {}
    own = record_key(key or df.columns)
    # the record as one struct keeps its names apart from the keys
    _take(tables, name, df.select(own.alias(ROW), F.struct(*df.columns).alias("_item")), [ROW])
    return tables


def _take(tables: dict[str, DataFrame], name: str, rows: DataFrame, keys: list[str]) -> None:
    found = _leaves(rows.schema["_item"].dataType, F.col("_item"), "")
    found = [(n or VALUE, at, kind) for n, at, kind in found]
    single = [at.alias(n) for n, at, kind in found if not isinstance(kind, T.ArrayType)]
    tables[name] = rows.select(*keys, *single)
    for below, at, kind in found:
        if not isinstance(kind, T.ArrayType):
            continue
        # a list of lists has no name of its own
        child = f"{name}{SEPARATOR}{below if below != VALUE else 'list'}"
        parts = rows.select(F.col(ROW).alias(PARENT), F.posexplode(at).alias(PLACE, "_item"))
        own = F.md5(F.concat_ws("/", PARENT, F.lit(below), F.col(PLACE).cast("string")))
        _take(tables, child, parts.withColumn(ROW, own), [ROW, PARENT, PLACE])


def write_lists(
    df: DataFrame, name: str, path: str, key: list[str] | None = None
) -> dict[str, DataFrame]:
    """Store every table in a folder of its name below ``path``.

    Most of their bytes are keys in hexadecimal digits: zstd codes such a digit in half a byte,
    which Parquet's default codec cannot.
    """
    out = {}
    for table, rows in split_lists(df, name, key).items():
        rows.write.mode("overwrite").parquet(f"{path}/{table}", compression="zstd")
        out[table] = df.sparkSession.read.schema(rows.schema).parquet(f"{path}/{table}")
    return out


_OTHER = b"\x00" * 17  # longer than a packed hash, so that no other text looks like one


def _packed(key: Column) -> Column:
    """A hash's 32 digits as 16 bytes, any other text as itself behind a mark, NULL as no bytes.

    Never NULL, so that joins by it do not compute it once more to filter NULLs.
    """
    digits = (F.octet_length(key) == 32) & (F.lower(key) == key)
    hashed = F.when(digits, F.unhex(key))  # NULL if these are no digits
    return F.coalesce(hashed, F.concat(F.lit(_OTHER), key.cast("binary")), F.lit(b""))


def _unpacked(key: Column) -> Column:
    other = F.substr(key, F.lit(len(_OTHER) + 1)).cast("string")
    hashed = F.when(F.octet_length(key) == 16, F.lower(F.hex(key)))
    return hashed.when(F.octet_length(key) > 16, other)


def with_parent(child: DataFrame, parent: DataFrame, columns: list[str]) -> DataFrame:
    """Elements with columns of the row whose list they are in.

    The keys are packed while rows are shuffled: they are most of what a row holds.
    """
    above = parent.select(F.col(ROW).alias(PARENT), *columns)
    text = T.StringType()
    if not child.schema[PARENT].dataType == above.schema[PARENT].dataType == text:
        return child.join(above, PARENT)
    # the child's own key too, unless the parent brings a column of that name
    own = [f.name for f in child.schema if f.name == ROW and f.dataType == text]
    keys = [PARENT, *(own if len(own) == 1 and ROW not in columns else [])]
    below = child.filter(F.col(PARENT).isNotNull()).withColumns({k: _packed(F.col(k)) for k in keys})
    above = above.filter(F.col(PARENT).isNotNull()).withColumn(PARENT, _packed(F.col(PARENT)))
    return below.join(above, PARENT).withColumns({k: _unpacked(F.col(k)) for k in keys})
