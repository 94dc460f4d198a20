"""Number cleaning expressions (STR2, CST1-CST3).

The reference cast text with Spark 3's lenient cast: control characters and
blanks trimmed at both ends, a fractional part dropped ('12.7' -> 12, '.5' and
'.' -> 0), anything else -> null.  Spark 4's ``try_cast`` returns null for
'12.7', so the sign and the integer digits are pulled out by a regex first;
``tests/test_functions.py`` holds the result against the non-ANSI cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# ---------------------------------------------------------------------------
# These must equal the reference for equal results.
# ---------------------------------------------------------------------------
THOUSANDS_SEPARATOR = ","
# ---------------------------------------------------------------------------

# what the cast trims: bytes up to the blank, and DEL
_EDGE = r"[\x00-\x20\x7F]*"
# an optional sign, then digits with an optional fraction, or a fraction alone
INTEGER_TEXT = rf"^{_EDGE}([+-]?[0-9]*)(?:(?<=[0-9])|(?=\.))(?:\.[0-9]*)?{_EDGE}\z"


def strip_thousands(c, sep: str = THOUSANDS_SEPARATOR) -> Column:
    """STR2: '8,932,568' -> '8932568' (a character delete, no regex)."""
    return F.translate(as_col(c), sep, "")


def to_int(c) -> Column:
    """CST1: text -> int; malformed or out of range -> null."""
    whole = F.regexp_extract(as_col(c), INTEGER_TEXT, 1)
    fraction_only = whole.isin("", "+", "-") & as_col(c).rlike(INTEGER_TEXT)
    return F.when(fraction_only, F.lit(0)).otherwise(whole.try_cast("int"))


def to_float(c) -> Column:
    """CST2: text -> float; malformed -> null."""
    return as_col(c).try_cast("float")


def to_bigint(c) -> Column:
    """CST3: assert a 64-bit integer column."""
    return as_col(c).cast("bigint")
