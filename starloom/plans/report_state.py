"""REP1-REP3 kept up to date (AGG1, AGG2): mergeable partial states per delivery.

A delivery leaves its partial sums and counts, per author, genre and title, as one
batch.  A report folds the partials, which are as many as there are names, not
records; a delivery taken back is no longer folded.  What deliveries share is not
looked for: each brings records of its own (``clean_records`` within one, a
``KeyRegistry`` increment between them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays
from ..operators.batches import BatchTables, Entry
from ..operators.topk import sort_desc

_SCHEMAS = {
    "authors": "author_name string, n long",
    "genres": "genre_name string, n long",
    "titles": "book_title string, rating_sum double, rating_n long, ratings long, reviews long",
}


class ReportState:
    def __init__(self, spark: SparkSession, path: str, trim_genres: bool = False):
        self.tables, self.trim_genres = BatchTables(spark, path), trim_genres

    def add(self, delivery: str, cleaned: DataFrame) -> Entry:
        """Fold a delivery's cleaned records into partials; one that is known adds nothing."""
        one = F.count(F.lit(1)).alias("n")
        names = cleaned.select(arrays.explode_items("genres", trim_items=self.trim_genres).alias("genre_name"))
        return self.tables.append(delivery, {
            "authors": cleaned.groupBy(F.col("author").alias("author_name")).agg(one),
            "genres": names.groupBy("genre_name").agg(one),
            "titles": cleaned.groupBy(F.col("title").alias("book_title")).agg(
                F.sum(F.col("rating").cast("double")).alias("rating_sum"), F.count("rating").alias("rating_n"),
                F.sum("num_ratings").cast("long").alias("ratings"), F.sum("reviews").cast("long").alias("reviews")),
        })

    def retract(self, delivery: str) -> None:
        self.tables.retract(delivery)

    def _counts(self, table: str, name: str) -> DataFrame:
        return sort_desc(self.tables.read(table, _SCHEMAS[table]).groupBy(name).agg(F.sum("n").alias("book_count")), "book_count", [name])

    def author_counts(self) -> DataFrame:
        """REP1 over all deliveries."""
        return self._counts("authors", "author_name")

    def genre_counts(self) -> DataFrame:
        """REP2 over all deliveries."""
        return self._counts("genres", "genre_name")

    def title_ratings(self) -> DataFrame:
        """REP3 over all deliveries."""
        folded = self.tables.read("titles", _SCHEMAS["titles"]).groupBy("book_title").agg(
            (F.sum("rating_sum") / F.sum("rating_n")).alias("average_rating"),
            F.sum("ratings").alias("total_ratings"), F.sum("reviews").alias("total_reviews"))
        return sort_desc(folded, "average_rating", ["book_title"])
