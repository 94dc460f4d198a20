"""JOB1: clean raw catalogue records.

One projection does every per-row step (date cascade, number casts, text
cleaning) in whole-stage codegen.  Exact duplicates are found by document id
first: only the rows of ids delivered more than once meet in full, so what reads
the cleaned records stays column-pruned down to the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, numbers, text
from ..operators.dedupe import drop_duplicates_by_id, drop_exact_duplicates

# ---------------------------------------------------------------------------
# These must equal the reference for equal results.
# Defaults for missing values, by cleaned column name.
# ---------------------------------------------------------------------------
FILL_DEFAULTS = {
    "rank": 0,
    "title": "No title",
    "author": "no author",
    "rating": 0.0,
    "num_ratings": 0,
    "description": "No description available",
    "reviews": 0,
    "pages": 0,
    "cover_type": "No cover type",
    "score": 0.0,
    "genres": "No genres",
}
# ---------------------------------------------------------------------------

CLEAN_COLUMNS = [
    "rank", "title", "author", "rating", "num_ratings", "reviews", "score", "pages",
    "cover_type", "date_text", "description", "genres", "cleaned_date", "publish_date",
]


def clean_record_columns(id_col: str | None = "_id", date_prefix: bool = True,
                         date_phrases: tuple[str, ...] = (dates.PUBLISHED_PREFIX,)) -> list:
    """The per-row cleaning of a raw record as a list of named expressions.
    ``date_phrases`` are removed from the date text before parsing (the
    reference removes only 'First published ', so 'Published ...' dates fall
    back to the default)."""
    cleaned_date = F.col("Date")
    for phrase in date_phrases:
        cleaned_date = text.remove_phrase(cleaned_date, phrase)
    cols = [] if id_col is None else [F.col(id_col)]
    return cols + [
        F.col("Rank").alias("rank"),
        F.col("Title").alias("title"),
        F.col("Author").alias("author"),
        numbers.to_float("Rating").alias("rating"),
        numbers.to_int(numbers.strip_thousands("`Number of Ratings`")).alias("num_ratings"),
        numbers.to_int(numbers.strip_thousands("Reviews")).alias("reviews"),
        numbers.to_int(numbers.strip_thousands("Score")).alias("score"),
        numbers.to_int("Pages").alias("pages"),
        F.col("`Cover Type`").alias("cover_type"),
        F.col("Date").alias("date_text"),
        text.clean_text_first_pass("Description").alias("description"),
        F.col("Genres").alias("genres"),
        cleaned_date.alias("cleaned_date"),
        dates.parse_publish_date(cleaned_date, prefix=date_prefix).alias("publish_date"),
    ]


def fill_defaults(df: DataFrame, as_of=None) -> DataFrame:
    """NUL1 + DAT6 + DAT7 (DQ4): per-column defaults for missing values."""
    present = {k: v for k, v in FILL_DEFAULTS.items() if k in df.columns}
    out = df.na.fill(present)
    extra = {}
    if "date_text" in out.columns:
        extra["date_text"] = dates.default_date_text("date_text", as_of)
    if "cleaned_date" in out.columns:
        extra["cleaned_date"] = dates.default_published_words("cleaned_date", as_of)
    return out.withColumns(extra) if extra else out


def fill_report(unfilled: DataFrame) -> DataFrame:
    """DQ4 as numbers: how many values each default replaced (nulls, and NaN
    in floating columns, as ``na.fill`` treats them), in one global aggregate
    over cleaned-but-unfilled records."""
    cols = [c for c in list(FILL_DEFAULTS) + ["date_text", "cleaned_date"] if c in unfilled.columns]
    types = dict(unfilled.dtypes)
    aggs = []
    for c in cols:
        missing = F.col(c).isNull()
        if types[c] in ("float", "double"):
            missing = missing | F.isnan(F.col(c))
        aggs.append(F.count_if(missing).alias(f"{c}_filled"))
    return unfilled.agg(*aggs)


def clean_records(raw: DataFrame, as_of=None, dedupe: str = "exact", id_col: str = "_id",
                  fill: bool = True, keep_id: bool = False,
                  date_prefix: bool = True,
                  date_phrases: tuple[str, ...] = (dates.PUBLISHED_PREFIX,), store_repeated: bool = True,
                  held: list | None = None) -> DataFrame:
    """JOB1.

    ``dedupe``: ``"exact"`` drops rows equal on every column including the
    document id (the reference's order: de-duplicate, then drop the id); ids held
    more than once are looked for when this is called (one narrow job over the
    id column) and their rows written, see ``drop_duplicates_by_id``; ``held``
    collects these tables.  ``store_repeated=False`` leaves these rows to each reader:
    for a star, which writes all cleaned columns once.  ``"lazy"`` gives the same rows by one aggregation over all
    columns, with no job before the first action.
    ``"content"`` ignores the id and drops documents that differ only in it.
    ``"none"`` keeps every row, for a caller who knows that no document comes
    twice.  ``keep_id`` keeps
    the document id as ``record_id`` (the reference drops it), so facts can
    attach to their own record instead of by title (``Star(attach="record")``).
    ``date_prefix`` parses dates as the reference's session did (a leading
    date, trailing text ignored); off, Spark's strict parser is used.
    """
    has_id = id_col in raw.columns
    out = raw.select(*clean_record_columns(id_col if has_id else None, date_prefix, date_phrases))
    if dedupe == "content":
        out = drop_exact_duplicates(out, ignore=[id_col] if has_id else [])
    elif dedupe == "exact" and has_id:
        out = drop_duplicates_by_id(out, id_col, raw.select(F.col(f"`{id_col}`")), store_repeated, held)
    elif dedupe in ("exact", "lazy"):
        out = out.dropDuplicates()
    elif dedupe != "none":
        raise ValueError("dedupe must be 'exact', 'lazy', 'content' or 'none'")
    if has_id and id_col in out.columns:
        out = out.withColumnRenamed(id_col, "record_id") if keep_id else out.drop(id_col)
    return fill_defaults(out, as_of) if fill else out
