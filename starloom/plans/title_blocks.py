"""Factorised title joins (JOIN2, JOB7-JOB9): the m x n pairs of a title, kept as its two sides.

A title shared by m books and n ratings stands for m x n pairs.  Counts, sums and
averages over the pairs, and the referential count of the bridge, follow from m, n
and the sums of either side: aggregates of linear size, whatever the fan-out.  Only
who wants the pairs themselves expands them, block by block: the ids of one side of
a title are held in blocks of at most about ``BLOCK`` ids, so no row and no task holds
a hot title whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import PAIRS_PER_TASK, hot_pairs, maybe_broadcast, salted_join
from ..operators.keys import Keyed, assign_dense_key, running_sum
from ..operators.materialize import Written, materialize
from ..operators.pair_registry import PairRegistry

#: Ids of one block, about.
BLOCK = 512


@dataclass
class TitleBlocks:
    """The join of ``left`` and ``right`` on ``on``, unexpanded.  Null titles join with
    nothing, as in the join itself."""

    left: DataFrame
    right: DataFrame
    on: str
    left_id: str
    right_id: str

    @classmethod
    def of(cls, books: Keyed, ratings: Keyed) -> "TitleBlocks":
        """Of the bridge of JOB8."""
        return cls(books.df, ratings.df, "book_title", "book_id", "rating_id")

    def counts(self, left: dict[str, Column] | None = None, right: dict[str, Column] | None = None) -> DataFrame:
        """(on, m, n) per shared title, with further aggregates of either side's own
        rows.  Both sides combine before they shuffle."""
        m = self.left.groupBy(self.on).agg(F.count(F.lit(1)).alias("m"), *[c.alias(k) for k, c in (left or {}).items()])
        n = self.right.groupBy(self.on).agg(F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in (right or {}).items()])
        return m.join(n, self.on)

    def pair_sums(self, left: dict[str, str] | None = None, right: dict[str, str] | None = None) -> DataFrame:
        """Per shared title: ``pairs``, and the sums over all its pairs of columns of
        either side (result name -> column).  A left value stands in n pairs, a right
        one in m; a sum of nulls only is null."""
        left, right = left or {}, right or {}
        rows = self.counts({k: F.sum(F.col(c)) for k, c in left.items()}, {k: F.sum(F.col(c)) for k, c in right.items()})
        return rows.select(self.on, (F.col("m") * F.col("n")).alias("pairs"),
                           *[(F.col(k) * F.col("n")).alias(k) for k in left], *[(F.col(k) * F.col("m")).alias(k) for k in right])

    def pair_count(self) -> DataFrame:
        """One row, DQ3 on the bridge: every pair takes its ids from its parents, so all
        are valid and none is rejected."""
        return self.counts().agg(F.coalesce(F.sum(F.col("m") * F.col("n")), F.lit(0)).cast("long").alias("valid_rows"),
                                 F.lit(0).cast("long").alias("rejected_rows"))

    def _blocks(self, side: DataFrame, key: str, out: str) -> DataFrame:
        """(on, out): the ids of a title in arrays of about ``BLOCK``."""
        narrow = side.filter(F.col(self.on).isNotNull()).select(self.on, F.col(key).alias("__id"))
        sizes = narrow.groupBy(F.col(self.on).alias("__hot")).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("__cuts")).filter(F.col("__cuts") > 1)
        # at most rows / BLOCK titles have more than one block
        hot = materialize(sizes, "hot-titles", rows=F.count(F.lit(1)), size=F.sum(F.octet_length(F.col("__hot").cast("string")) + 48))
        cut = F.lit(0).cast("long")
        if hot.metrics["rows"]:
            narrow = narrow.join(maybe_broadcast(hot.df, int(hot.metrics["size"])), F.col(self.on) == F.col("__hot"), "left")
            cut = F.pmod(F.xxhash64("__id"), F.coalesce("__cuts", F.lit(1)))
        return narrow.groupBy(self.on, cut.alias("__cut")).agg(F.collect_list("__id").alias(out)).drop("__cut")

    def blocks(self) -> tuple[DataFrame, DataFrame]:
        """Both sides as (title, ids) blocks: linear in the rows."""
        return self._blocks(self.left, self.left_id, "__left"), self._blocks(self.right, self.right_id, "__right")

    def expanded(self) -> DataFrame:
        """All pairs (left_id, right_id).  Titles of many pairs of blocks are cut on both
        sides, so that a task expands about ``PAIRS_PER_TASK``."""
        left, right = (materialize(x, "title-blocks").df for x in self.blocks())
        met = salted_join(left, right, self.on, hot=hot_pairs(left, right, self.on, max(1, PAIRS_PER_TASK // BLOCK ** 2)))
        one = met.select(F.explode("__left").alias(self.left_id), "__right")
        return one.select(self.left_id, F.explode("__right").alias(self.right_id))


#: Rows of one side of a title in one block of reviews, about.
REVIEW_BLOCK = 1024


def _met_blocks(left: DataFrame, right: DataFrame, on: str, rows: int) -> Written:
    """Pairs of blocks, written; a file holds about as many of the ``rows`` pairs as any other."""
    met = salted_join(left, right, on, hot=hot_pairs(left, right, on, max(1, PAIRS_PER_TASK // REVIEW_BLOCK ** 2)))
    return materialize(met.drop(on).repartition(max(1, -(-rows // PAIRS_PER_TASK))), "review-pairs")


@dataclass
class ReviewBlocks:
    """JOB7 unexpanded: the m x n reviews of a title, as its m books and its n records.

    Reviews are numbered by book, within a book by (reviews, score).  All books of a title
    have the same records in the same order, so the id of a pair is a sum of two numbers,
    one of its book and one of its record: the reviews of all books before, less the place
    of the title's first record, plus the record's own place among all records by title.
    Both come from the two sides; no pair is sorted, shuffled or written to number it.

    ``pairs`` holds pairs of blocks, dealt evenly by their rows, and a reader expands
    them where it reads them.
    """

    bases: Written
    records: Written
    pairs: Written
    rows: int

    @classmethod
    def of(cls, cleaned: DataFrame, books: Keyed, order: list[str], ties: str = "write") -> "ReviewBlocks":
        """``order``: the record columns by which a book's reviews are numbered (none: by
        their place in the input)."""
        recs = cleaned.select(F.col("title").alias("book_title"), "reviews", "score").filter(F.col("title").isNotNull())
        placed = assign_dense_key(recs, ["book_title", *order], "__at", ties=ties)
        per = placed.df.groupBy(F.col("book_title").alias("__t")).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
        own = books.df.select("book_id", "book_title")
        sizes = own.groupBy("book_title").agg(F.count(F.lit(1)).alias("__m")).join(per, F.col("book_title") == F.col("__t")).drop("__t")
        placed_books = own.join(sizes, "book_title")
        before = running_sum(placed_books, "book_id", "__n", "__before")
        bases = materialize(before.df.select("book_id", "book_title", (F.col("__before") - F.col("__first")).alias("__base"), "__m"), "review-bases")
        before.remove()
        record = F.struct("__at", "reviews", "score")
        records = materialize(placed.df.groupBy("book_title", F.floor(F.col("__at") / REVIEW_BLOCK).alias("__cut"))
                              .agg(F.collect_list(record).alias("__right")).drop("__cut"), "review-records")
        placed.remove()
        cut = F.pmod(F.xxhash64("book_id"), F.ceil(F.col("__m") / REVIEW_BLOCK))
        left = materialize(bases.df.groupBy("book_title", cut.alias("__cut")).agg(F.collect_list(F.struct("book_id", "__base")).alias("__left")).drop("__cut"), "review-books")
        rows = before.rows
        pairs = _met_blocks(left.df, records.df, "book_title", rows)
        left.remove()
        return cls(bases, records, pairs, rows)

    @property
    def path(self) -> str:
        return self.pairs.path

    def expanded(self) -> DataFrame:
        """The reviews (review_id, book_id, reviews, score): a scan, expanded where it is read."""
        one = self.pairs.df.select(F.explode("__left").alias("__l"), "__right")
        return self._shown(one.select("__l.book_id", "__l.__base", F.explode("__right").alias("__r")), "book_id")

    @staticmethod
    def _shown(rows: DataFrame, *columns: str) -> DataFrame:
        return rows.select((F.col("__base") + F.col("__r.__at")).alias("review_id"), *columns, "__r.reviews", "__r.score")

    def with_books(self, books: DataFrame) -> DataFrame:
        """The reviews with all columns of ``books``, which meet blocks of records, not reviews."""
        based = books.join(self.bases.df.select("book_id", "__base"), "book_id")
        narrow = self.bases.df.select("book_title")
        hot = hot_pairs(narrow, self.records.df, "book_title", max(1, PAIRS_PER_TASK // REVIEW_BLOCK))
        met = salted_join(based, self.records.df, "book_title", hot=hot)
        rows = met.select(*books.columns, "__base", F.explode("__right").alias("__r"))
        return self._shown(rows, *books.columns).select(*books.columns, "review_id", "reviews", "score")

    def remove(self) -> None:
        for table in (self.bases, self.records, self.pairs):
            table.remove()


def _cut(rows: DataFrame) -> DataFrame:
    """``rows``, a scan, with ``__cut``: those of a title dealt by their places to cuts of
    about ``REVIEW_BLOCK``, whatever ids they repeat."""
    sizes = rows.groupBy(F.col("book_title").alias("__hot")).agg(F.ceil(F.count(F.lit(1)) / REVIEW_BLOCK).alias("__cuts")).filter(F.col("__cuts") > 1)
    hot = materialize(sizes, "hot-titles", size=F.sum(F.octet_length("__hot") + 48))
    placed = rows.withColumn("__p", F.monotonically_increasing_id())
    cut = placed.join(maybe_broadcast(hot.df, int(hot.metrics["size"] or 0)), F.col("book_title") == F.col("__hot"), "left")
    return cut.withColumn("__cut", F.pmod(F.xxhash64("__p"), F.coalesce("__cuts", F.lit(1)))).drop("__p", "__hot", "__cuts")


def registered_reviews(cleaned: DataFrame, books: Keyed, registry: PairRegistry) -> Keyed:
    """JOB7 by title with ids of ``registry``, which holds the titles of ``books``: pairs of
    blocks, expanded where they are read.  Both sides of a title go by the kinds of their
    keys and the delivery that a pair came with: an id is a number of the book plus a place
    of the record (see ``PairRegistry``)."""
    numbers = registry.numbers()
    titled = F.col("book_title").isNotNull()
    held = [materialize(rows.filter(titled), "review-sides") for rows in (
        books.df.select("book_title", "book_id").join(numbers.kinds.df.select("book_id", "__kind"), "book_id"),
        cleaned.select(F.col("title").alias("book_title"), "record_id", "reviews", "score"))]
    own, recs = (table.df for table in held)
    # title, kind and delivery in one column: the first two parts hold no ":"
    key = F.concat_ws(":", "__kind", F.col("__gen").cast("string"), "book_title").alias("__key")
    based = _cut(own).join(numbers.bases.df, "book_id")
    left = based.groupBy(key, "__cut").agg(F.collect_list(F.struct("book_id", "__base")).alias("__left")).drop("__cut")
    seen = _cut(recs).join(own.select("book_title", "__kind").distinct(), "book_title")
    place = numbers.places.df.select("__at", F.col("__kind").alias("__k"), "__gen", F.col("record_id").alias("__r"))
    placed = seen.join(place, (F.col("__kind") == F.col("__k")) & F.col("record_id").eqNullSafe(F.col("__r")))
    record = F.struct("__at", "reviews", "score", "record_id")
    right = placed.groupBy(key, "__cut").agg(F.collect_list(record).alias("__right")).drop("__cut")
    sides = [materialize(left, "review-books"), materialize(right, "review-records")]
    m, n = (side.df.groupBy("__key").agg(F.sum(F.size(c)).alias(c)) for side, c in zip(sides, ("__left", "__right")))
    rows = m.join(n, "__key").agg(F.sum(F.col("__left") * F.col("__right"))).first()[0] or 0
    pairs = _met_blocks(sides[0].df, sides[1].df, "__key", rows)
    for table in (*held, *sides, numbers):
        table.remove()
    one = pairs.df.select(F.explode("__left").alias("__l"), "__right")
    out = one.select("__l.book_id", "__l.__base", F.explode("__right").alias("__r"))
    out = out.select((F.col("__base") + F.col("__r.__at")).alias("review_id"), "book_id", "__r.reviews", "__r.score", "__r.record_id")
    return Keyed(out, "review_id", rows, path=pairs.path, dense=False)
