"""Column-expression builders: text, dates, numbers, multi-value lists."""

from .arrays import explode_items, join_items, split_items
from .dates import (
    default_date_text,
    default_published_words,
    format_day_month_year,
    lenient_date,
    parse_date_cascade,
    parse_day_month_year,
    parse_publish_date,
    try_parse_date,
)
from .numbers import strip_thousands, to_bigint, to_float, to_int
from .text import (
    classify_text,
    clean_text,
    clean_text_first_pass,
    clean_text_second_pass,
    is_unusable_text,
    remove_phrase,
    strip_text,
)

__all__ = [
    "classify_text",
    "clean_text",
    "clean_text_first_pass",
    "clean_text_second_pass",
    "default_date_text",
    "default_published_words",
    "explode_items",
    "format_day_month_year",
    "is_unusable_text",
    "join_items",
    "lenient_date",
    "parse_date_cascade",
    "parse_day_month_year",
    "parse_publish_date",
    "remove_phrase",
    "split_items",
    "strip_text",
    "strip_thousands",
    "to_bigint",
    "to_float",
    "to_int",
    "try_parse_date",
]
