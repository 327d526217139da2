"""Code to label lookups small enough to live in an expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: vendor code -> name; every other code has no name
VENDOR_NAMES = {
    1: "Creative Mobile Technologies, LLC",
    2: "VeriFone Inc.",
    4: "Unknown Vendor",
}

# fixed values: payment code -> description
PAYMENT_DESCRIPTIONS = {
    0: "Unknown",
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}

# fixed values: payment code -> name in the second vocabulary
PAYMENT_NAMES = {
    0: "flex_fare",
    1: "credit_card",
    2: "cash",
    3: "no_charge",
    4: "dispute",
    5: "unknown",
    6: "voided_trip",
}


def label(col: Column | str, names: dict[int, str], default: str | None = None) -> Column:
    """Label of a code; ``default`` (NULL if not given) for codes without one."""
    code = F.col(col) if isinstance(col, str) else col
    out = F.lit(None).cast("string")
    if default is not None:
        out = F.lit(default)
    branches = None
    for value, name in names.items():
        branches = (F if branches is None else branches).when(code == value, F.lit(name))
    return out if branches is None else branches.otherwise(out)


def vendor_label(col: Column | str) -> Column:
    return label(col, VENDOR_NAMES)


def payment_label(col: Column | str) -> Column:
    return label(col, PAYMENT_DESCRIPTIONS, default="Unknown")


def base_code(col: Column | str) -> Column:
    """``B02884`` -> ``s/b44``: class letter by divisibility, then at least three hex digits.

    Built from JVM expressions so the scan stays inside code generation; text without a
    number after the first character gives NULL.
    """
    text = F.col(col) if isinstance(col, str) else col
    number = F.substr(text, F.lit(2)).try_cast("bigint")
    letter = F.when(number % 7 == 0, "s").when(number % 3 == 0, "a").otherwise("e")
    return F.when(number.isNotNull(), F.format_string("%s/%03x", letter, number))
