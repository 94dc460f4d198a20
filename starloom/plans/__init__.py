"""User-level jobs: cleaning, star schema, views, reports, export, loads."""

from .clean import CLEAN_COLUMNS, FILL_DEFAULTS, clean_records, fill_defaults
from .reports import author_counts, genre_counts, title_ratings, top_authors
from .star import Star
from .views import (
    book_genre_ids,
    book_rating_details,
    books_final,
    books_genre_names,
    books_left_ratings,
    books_ratings_wide,
    books_reviews,
    ratings_left_books,
)

__all__ = [
    "CLEAN_COLUMNS",
    "FILL_DEFAULTS",
    "Star",
    "author_counts",
    "book_genre_ids",
    "book_rating_details",
    "books_final",
    "books_genre_names",
    "books_left_ratings",
    "books_ratings_wide",
    "books_reviews",
    "clean_records",
    "fill_defaults",
    "genre_counts",
    "ratings_left_books",
    "title_ratings",
    "top_authors",
]
