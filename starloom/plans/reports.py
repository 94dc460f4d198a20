"""REP1-REP3: ranked reports.

Each report is one partial + final hash aggregation.  The reference counts
over ``books_final`` and looks names up by id afterwards; since every id is a
dense key of a name taken from the same column, counting by the name itself
gives the same rows without building ``books_final`` at all (no key
assignment, no regrouping).  A hot author or genre is folded map-side by the
partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import arrays
from ..operators.topk import sort_desc, top_k
from .star import books_rows


def author_counts(cleaned: DataFrame) -> DataFrame:
    """REP1: books per author, descending."""
    books = books_rows(cleaned)
    counts = books.groupBy(F.col("author").alias("author_name")).agg(F.count(F.lit(1)).alias("book_count"))
    return sort_desc(counts, "book_count", ["author_name"])


def genre_counts(cleaned: DataFrame, trim_items: bool = False) -> DataFrame:
    """REP2: books per genre, descending.  A genre listed twice by one book
    counts twice (the reference counts list entries, not distinct pairs)."""
    names = cleaned.select(arrays.explode_items("genres", trim_items=trim_items).alias("genre_name"))
    counts = names.groupBy("genre_name").agg(F.count(F.lit(1)).alias("book_count"))
    return sort_desc(counts, "book_count", ["genre_name"])


def title_ratings(cleaned: DataFrame) -> DataFrame:
    """REP3: per title the average rating and the totals of ratings and
    reviews, descending by average."""
    agg = cleaned.groupBy(F.col("title").alias("book_title")).agg(
        F.avg("rating").alias("average_rating"),
        F.sum("num_ratings").alias("total_ratings"),
        F.sum("reviews").alias("total_reviews"),
    )
    return sort_desc(agg, "average_rating", ["book_title"])


def top_authors(cleaned: DataFrame, k: int = 20) -> DataFrame:
    """SRT2: the first ``k`` rows of REP1 (ties broken by name)."""
    return top_k(author_counts(cleaned), "book_count", k, ["author_name"])
