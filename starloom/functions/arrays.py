"""Multi-value text columns (STR6, STR7, ARR1, SNK6)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# ---------------------------------------------------------------------------
# These must equal the reference for equal results.
# ---------------------------------------------------------------------------
ITEM_SEPARATOR = ","
# ---------------------------------------------------------------------------


def split_items(c, sep: str = ITEM_SEPARATOR, trim_items: bool = False) -> Column:
    """STR6: 'a, b,c' -> ['a', ' b', 'c'].  Items keep their blanks unless
    ``trim_items``; empty items are kept, as Spark's split does."""
    arr = F.split(as_col(c), re.escape(sep))
    return F.transform(arr, lambda x: F.trim(x)) if trim_items else arr


def explode_items(c, sep: str = ITEM_SEPARATOR, trim_items: bool = False) -> Column:
    """ARR1: one row per item; a null list gives no row."""
    return F.explode(split_items(c, sep, trim_items))


def join_items(c, sep: str = ITEM_SEPARATOR) -> Column:
    """STR7/SNK6: array -> text; nulls skipped, empty array -> ''."""
    return F.concat_ws(sep, as_col(c).cast("array<string>"))
