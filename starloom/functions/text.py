"""Free-text cleaning as column expressions (STR1, STR3-5, STR9, STR10).

Everything here is a built-in Catalyst expression, so it runs inside
whole-stage codegen on every row of a partition; nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# ---------------------------------------------------------------------------
# These must equal the reference for equal results.
# ---------------------------------------------------------------------------
PLACEHOLDER_TEXT = "No description available"
ONLY_DIGITS = "^[0-9]+$"
ONLY_WHITESPACE = "^[\\s]+$"
DIGITS_LETTERS_EDGE = "^[0-9]+[a-zA-Z]+|[a-zA-Z]+[0-9]+$"
DOUBLE_QUOTE = '"'
NOT_ASCII_WORD = "[^a-zA-Z0-9\\s]"
# ---------------------------------------------------------------------------

# The same test as DIGITS_LETTERS_EDGE in linear time: "letters then digits at
# the end" holds exactly when the final digit run is preceded by a letter, so
# one letter suffices; the greedy "[a-zA-Z]+" retries every suffix of every
# word (quadratic per word).  "$" keeps Java's meaning (end, or before a final
# line terminator) in both.
DIGITS_LETTERS_EDGE_FAST = "^[0-9]+[a-zA-Z]|[a-zA-Z][0-9]+$"

UNUSABLE_PATTERNS = (ONLY_DIGITS, ONLY_WHITESPACE, DIGITS_LETTERS_EDGE_FAST)

# Deleting each unwanted character and deleting whole runs of them is the
# same edit; runs mean fewer match events.
NOT_ASCII_WORD_RUN = NOT_ASCII_WORD + "+"


def remove_phrase(c, phrase: str) -> Column:
    """STR1: delete every occurrence of a fixed phrase (literal, not a regex)."""
    return F.replace(as_col(c), F.lit(phrase), F.lit(""))


def is_unusable_text(c, patterns=UNUSABLE_PATTERNS) -> Column:
    """STR9 predicate: null, blank after trim, or any unanchored pattern hit."""
    col = as_col(c)
    cond = col.isNull() | (F.trim(col) == "")
    for p in patterns:
        cond = cond | col.rlike(p)
    return cond


def classify_text(c, placeholder: str = PLACEHOLDER_TEXT, patterns=UNUSABLE_PATTERNS) -> Column:
    """STR9: replace unusable free text by the placeholder, else keep it."""
    col = as_col(c)
    return F.when(is_unusable_text(col, patterns), F.lit(placeholder)).otherwise(col)


def strip_text(c) -> Column:
    """STR3 + STR4: drop double quotes, then everything but ASCII letters,
    digits and whitespace.  Idempotent: its output holds only kept chars."""
    col = as_col(c)
    return F.regexp_replace(F.replace(col, F.lit(DOUBLE_QUOTE), F.lit("")), NOT_ASCII_WORD_RUN, "")


def clean_text_first_pass(c, placeholder: str = PLACEHOLDER_TEXT) -> Column:
    """Validate, then strip (the raw-record cleaning order)."""
    return strip_text(classify_text(c, placeholder))


def clean_text_second_pass(c, placeholder: str = PLACEHOLDER_TEXT, already_stripped: bool = False) -> Column:
    """Strip, then validate (the books-table order).  On the output of a first
    pass the strip is a no-op (``strip_text`` is idempotent and the
    placeholder holds only kept characters), so ``already_stripped`` skips it."""
    return classify_text(c if already_stripped else strip_text(c), placeholder)


def clean_text(c, passes: int = 2, placeholder: str = PLACEHOLDER_TEXT) -> Column:
    """STR10: the composite cleaning, ``passes`` deep.

    Pass 1 validates then strips; every later pass strips then validates.  A
    third pass changes nothing (strip and classify are idempotent on a text
    that survived pass 2), so ``passes=2`` is the full result.
    """
    out = clean_text_first_pass(c, placeholder)
    for _ in range(max(passes - 1, 0)):
        out = clean_text_second_pass(out, placeholder, already_stripped=True)
    return out
