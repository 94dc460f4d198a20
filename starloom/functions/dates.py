"""Date parsing and formatting expressions (DAT1-DAT8, STR8).

Spark 4 runs with ANSI on, where ``to_date(c, fmt)`` raises on a bad value, so
every parse here goes through ``try_to_timestamp`` and yields null instead.
The cascade reads dates as the reference's session did (its LEGACY parser): a
date at the start of the text, whatever follows; ``prefix=False`` asks for
Spark's strict parser instead.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# ---------------------------------------------------------------------------
# These must equal the reference for equal results.
# ---------------------------------------------------------------------------
PUBLISHED_PREFIX = "First published "
DATE_FORMATS = ("MMMM d, yyyy", "yyyy", "MMMM yyyy")
DEFAULT_DATE = _dt.date(1900, 1, 1)
ISO_DATE = "yyyy-MM-dd"
DAY_MONTH_YEAR = "dd-MM-yyyy"
PLACEHOLDER_DATE_PREFIX = "Published "
PLACEHOLDER_DATE_WORDS = "MMMM dd, yyyy"
# ---------------------------------------------------------------------------


def _as_of(as_of) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def try_parse_date(c, fmt: str | None = None) -> Column:
    """Parse text to a date with one pattern; a bad value gives null."""
    col = as_col(c)
    ts = F.try_to_timestamp(col) if fmt is None else F.try_to_timestamp(col, F.lit(fmt))
    return ts.cast("date")


_MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
           "November", "December")
_MONTH_NAMES = "(?i:" + "|".join(_MONTHS + tuple(m[:3] for m in _MONTHS)) + ")"
_FIELDS = (  # pattern letters -> (regex of the text, letter of the canonical pattern)
    ("MMMM", _MONTH_NAMES, "MMM"), ("MMM", _MONTH_NAMES, "MMM"), ("MM", "[0-9]+", "M"), ("M", "[0-9]+", "M"),
    ("dd", "[0-9]+", "d"), ("d", "[0-9]+", "d"), ("yyyy", "[0-9]+", "y"), ("yy", "[0-9]+", "y"), ("y", "[0-9]+", "y"),
)


def _parse_leading(c, fmt: str) -> Column:
    """The date at the start of a text, for a pattern of M, d, y and literal
    characters, as the legacy parser reads it: blanks before a number are
    skipped, names of months may be short and in any case, numbers may have any
    width (but no year is 0), other characters must be there, and what follows
    the last field is ignored."""
    regex, fields, real, i = "^", [], F.lit(True), 0
    while i < len(fmt):
        for letters, rx, canonical in _FIELDS:
            if fmt.startswith(letters, i):
                blanks = "" if canonical == "MMM" else r"[ \t]*"
                regex, i = regex + rf"{blanks}({rx})", i + len(letters)
                fields.append(canonical)
                break
        else:
            regex, i = regex + re.escape(fmt[i]), i + 1
    parts = []
    for n, canonical in enumerate(fields, 1):
        found = F.regexp_extract(as_col(c), regex, n)
        parts.append(F.initcap(F.substring(found, 1, 3)) if canonical == "MMM" else found)
        if canonical == "y":
            real = ~found.rlike("^0+$")
    return F.when((parts[0] != "") & real, try_parse_date(F.concat_ws(" ", *parts), " ".join(fields)))


def parse_date_cascade(c, formats=DATE_FORMATS, prefix: bool = True) -> Column:
    """DAT1: the first format that parses wins.

    By default a date at the start of the text is read and anything after it
    ignored ('2022 foo' -> 2022-01-01, 'Jul 15, 2022' -> 2022-07-15), as the
    reference's legacy parser did; ``prefix=False`` is Spark's strict parser.
    """
    if not prefix:
        return F.coalesce(*[try_parse_date(c, f) for f in formats])
    return F.coalesce(*[_parse_leading(c, f) for f in formats])


def parse_publish_date(c, formats=DATE_FORMATS, default: _dt.date = DEFAULT_DATE, prefix: bool = True) -> Column:
    """DAT1 + DAT2 + DAT3: cascade, then the default date for failures."""
    return F.coalesce(parse_date_cascade(c, formats, prefix), F.lit(default))


def format_day_month_year(c) -> Column:
    """DAT4: date -> 'dd-MM-yyyy' text."""
    return F.date_format(as_col(c), DAY_MONTH_YEAR)


def parse_day_month_year(c) -> Column:
    """DAT5: 'dd-MM-yyyy' text -> date (null when malformed)."""
    return try_parse_date(c, DAY_MONTH_YEAR)


def default_date_text(c, as_of=None) -> Column:
    """DAT6: a null text date becomes the as-of day as 'yyyy-MM-dd'."""
    return F.coalesce(as_col(c), F.date_format(_as_of(as_of), ISO_DATE))


def default_published_words(c, as_of=None) -> Column:
    """DAT7 + STR8: a null becomes 'Published <Month dd, yyyy>' of the as-of day."""
    words = F.concat(F.lit(PLACEHOLDER_DATE_PREFIX), F.date_format(_as_of(as_of), PLACEHOLDER_DATE_WORDS))
    return F.coalesce(as_col(c), words)


def lenient_date(c) -> Column:
    """DAT8: lenient parse (ISO date or timestamp text), bad value -> null, then
    truncate to the day."""
    return try_parse_date(c)
