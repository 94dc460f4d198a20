"""JOB2-JOB8: the star schema (books, authors, genres, ratings, reviews and the
two bridges) from cleaned records.

Keys are assigned once per table (``assign_dense_key``), each keyed table is
written to the shared checkpoint folder, and every later table and view reads
those rows, so keys agree across all outputs (the reference recomputed them
per action and they could disagree).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import arrays, text
from ..operators.dedupe import distinct_values
from ..operators.joins import PAIRS_PER_TASK, hot_pairs, maybe_broadcast, salted_join
from ..operators.key_registry import KeyRegistry, Ledger
from ..operators.keys import Keyed, assign_dense_key
from ..operators.materialize import materialize
from ..operators.pair_registry import PairRegistry
from ..session import remove_path
from .title_blocks import ReviewBlocks, registered_reviews

# Total orders that define each table's keys.  Rows tied on every listed
# column are identical, so the numbering is deterministic.
BOOK_ORDER = ["book_title", "author", "num_pages", "cover_type", "publish_date", "genres",
              "rating", "description"]
RATING_ORDER = ["book_title", "rating", "num_ratings", "num_reviews", "score"]
REVIEW_ORDER = ["book_id", "reviews", "score"]


def _record(cleaned: DataFrame) -> list:
    return ["record_id"] if "record_id" in cleaned.columns else []


def books_rows(cleaned: DataFrame) -> DataFrame:
    """JOB2 without keys: the book columns, description cleaned a second time
    (``cleaned`` is JOB1 output, whose description is already stripped)."""
    return cleaned.select(
        *_record(cleaned),
        F.col("title").alias("book_title"),
        F.col("pages").alias("num_pages"),
        "cover_type",
        "publish_date",
        "genres",
        "rating",
        "author",
        text.clean_text_second_pass("description", already_stripped=True).alias("description"),
    )


def build_books(cleaned: DataFrame, key_order: str = "natural", buckets: int | None = None,
                ties: str = "write") -> Keyed:
    order = BOOK_ORDER + _record(cleaned) if key_order == "natural" else []
    return assign_dense_key(books_rows(cleaned), order, "book_id", buckets=buckets, ties=ties)


def build_authors(cleaned: DataFrame) -> Keyed:
    """JOB3: distinct author names, keyed in name order."""
    names = distinct_values(cleaned.withColumnRenamed("author", "author_name"), "author_name")
    return assign_dense_key(names, ["author_name"], "author_id", measure_bytes=True, ties="none")


def genre_names(df: DataFrame, col: str = "genres", trim_items: bool = False) -> DataFrame:
    return df.select(arrays.explode_items(col, trim_items=trim_items).alias("genre_name"))


def build_genres(cleaned: DataFrame, trim_items: bool = False) -> Keyed:
    """JOB4: distinct items of the multi-value genre column, keyed in name
    order.  Items are not trimmed by default, so ' Crime' and 'Crime' are two
    genres, as in the reference."""
    names = distinct_values(genre_names(cleaned, trim_items=trim_items), "genre_name")
    return assign_dense_key(names, ["genre_name"], "genre_id", measure_bytes=True, ties="none")


def ratings_rows(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(
        *_record(cleaned),
        F.col("title").alias("book_title"),
        "rating",
        "num_ratings",
        F.col("reviews").alias("num_reviews"),
        "score",
    )


def build_ratings(cleaned: DataFrame, key_order: str = "natural", ties: str = "write") -> Keyed:
    """JOB6: one rating row per record."""
    order = RATING_ORDER + _record(cleaned) if key_order == "natural" else []
    return assign_dense_key(ratings_rows(cleaned), order, "rating_id", ties=ties)


ATTACH_KEYS = {"title": "book_title", "record": "record_id"}


MEASURE = "measure"


def key_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", hot=MEASURE, tasks: int | None = None) -> DataFrame:
    """Equi-join on a column both sides name ``key`` (kept once).  ``hot`` is
    what ``hot_pairs`` found, measured here unless given (None: nothing to cut);
    keys with many output pairs are cut on both sides, whatever AQE is set to."""
    if isinstance(hot, str):
        hot = hot_pairs(left, right, key)
    return salted_join(left, right, key, how, hot, tasks)


def _hot(left: DataFrame, right: DataFrame, attach: str, hot):
    """Records are unique, titles are measured."""
    if attach == "record":
        return None
    return hot_pairs(left, right, ATTACH_KEYS[attach]) if isinstance(hot, str) else hot


def review_rows(cleaned: DataFrame, books: Keyed, attach: str = "title", hot=MEASURE) -> DataFrame:
    """JOB7 without keys: the reviews with the books they attach to, and their
    own record if there is one."""
    k = ATTACH_KEYS[attach]
    recs = cleaned.select(F.col("title").alias("book_title"), "reviews", "score", *_record(cleaned))
    other = books.df.select(k, "book_id")
    pairs = key_join(recs, other, k, "inner", _hot(recs, other, attach, hot))
    return pairs.select("book_id", "reviews", "score", *_record(cleaned))


def review_blocks(cleaned: DataFrame, books: Keyed, key_order: str = "natural", ties: str = "write") -> ReviewBlocks:
    """JOB7 by title, unexpanded.  In input order a book's reviews go by their records' places."""
    return ReviewBlocks.of(cleaned, books, REVIEW_ORDER[1:] if key_order == "natural" else [], ties)


def titled_reviews(blocks: ReviewBlocks) -> Keyed:
    return Keyed(blocks.expanded(), "review_id", blocks.rows, path=blocks.path)


def build_reviews(cleaned: DataFrame, books: Keyed, attach: str = "title", key_order: str = "natural", hot=MEASURE) -> Keyed:
    """JOB7: review facts, the book found by title.  A title shared by m books
    and n records gives m x n rows, as in the reference; titles with many pairs
    are cut on both sides.  With ``attach="record"`` each record's review
    attaches to the book of the same record (1:1, no fan-out, immune to a hot
    title such as the 'No title' placeholder).

    By title, the m x n rows are numbered from their two sides and kept as those
    (``ReviewBlocks``): they are expanded where they are read."""
    if attach == "title":
        return titled_reviews(review_blocks(cleaned, books, key_order))
    rows = review_rows(cleaned, books, attach, hot).select("book_id", "reviews", "score")
    order = REVIEW_ORDER if key_order == "natural" else []
    return assign_dense_key(rows, order, "review_id")


def build_book_genres(books: Keyed, genres: Keyed, trim_items: bool = False) -> DataFrame:
    """JOB5: unique (book_id, genre_id) pairs.

    A book's pairs all come from its own row, so duplicates are removed inside
    the row (``array_distinct``) instead of by a shuffle; the genre dimension
    is broadcast when its measured size allows.
    """
    items = F.array_distinct(arrays.split_items("genres", trim_items=trim_items))
    exploded = books.df.select("book_id", F.explode(items).alias("genre_name"))
    dim = maybe_broadcast(genres.df, genres.data_bytes)
    return exploded.join(dim, "genre_name", "inner").select("book_id", "genre_id")


def title_pairs(books: Keyed, ratings: Keyed, attach: str = "title", hot=MEASURE, tasks: int | None = None) -> DataFrame:
    """Book x rating pairs sharing a title (JOIN2), or the same record; titles
    with many pairs are cut on both sides."""
    k = ATTACH_KEYS[attach]
    b = books.df.select("book_id", k)
    r = ratings.df.select("rating_id", k)
    return key_join(b, r, k, "inner", _hot(b, r, attach, hot), tasks).select("book_id", "rating_id")


def title_fan_out(books: Keyed, ratings: Keyed) -> DataFrame:
    """Size of the title join before running it: per shared title m books and
    n ratings give m x n pairs.  One row: shared titles, total pairs, and the
    largest single title's pairs (a placeholder title held by a third of all
    records shows up here).  Two partial aggregations over narrow title
    columns and a join of per-title counts; no pair is materialised."""
    m = books.df.groupBy("book_title").agg(F.count(F.lit(1)).alias("m"))
    n = ratings.df.groupBy(F.col("book_title")).agg(F.count(F.lit(1)).alias("n"))
    per_title = m.join(n, "book_title").select((F.col("m") * F.col("n")).alias("pairs"))
    return per_title.agg(
        F.count(F.lit(1)).alias("shared_titles"),
        F.coalesce(F.sum("pairs"), F.lit(0)).alias("total_pairs"),
        F.coalesce(F.max("pairs"), F.lit(0)).alias("max_title_pairs"),
    )


def build_book_ratings(books: Keyed, ratings: Keyed, attach: str = "title", hot=MEASURE, tasks: int | None = None) -> DataFrame:
    """JOB8: the bridge.  Both ids are taken from their parents' tables, so the
    reference's filter against the parents' keys (JOIN6) keeps every pair and is
    not run; pairs from elsewhere go through ``keep_existing``."""
    return title_pairs(books, ratings, attach, hot, tasks)


#: Natural keys of the tables in a registry; the type of a record id is the source's.
REGISTERED = {
    "books": ("book_id", ["record_id"]), "authors": ("author_id", ["author_name"]), "genres": ("genre_id", ["genre_name"]),
    "ratings": ("rating_id", ["record_id"]), "reviews": ("review_id", ["book_id", "record_id"]),
}


def registered(rows: DataFrame, table: str, path: str, delivery: str, whole: bool = False) -> Keyed:
    """``rows`` with ids from the registry of ``table`` below ``path``, which
    ``delivery`` extends: ids given before stay.  ``whole`` gives all that the registry
    knows by then (a dimension), not only the names of these rows."""
    key, natural = REGISTERED[table]
    types = {f.name: f for f in rows.schema.fields}
    registry = KeyRegistry(rows.sparkSession, f"{path.rstrip('/')}/{table}", T.StructType([types[c] for c in natural]), key)
    registry.extend(rows, delivery)
    made = materialize(registry.keys(delivery).select(key, *natural) if whole else registry.attach(rows), f"registered-{table}", rows=F.count(F.lit(1)))
    columns = [key, *[c for c in made.df.columns if c != key]]
    return Keyed(made.df.select(*columns), key, made.metrics["rows"], path=made.path, dense=False)


def review_registry(books: Keyed, path: str) -> PairRegistry:
    """The registry of reviews by title below ``path``: it keeps the titles of the books of
    each delivery, not the pairs."""
    columns = ["book_title", "book_id", "record_id"]
    return PairRegistry(books.df.sparkSession, f"{path.rstrip('/')}/reviews-by-title", books.df.select(*columns).schema, *columns)


@dataclass
class Star:
    """Lazily built star schema over one cleaned table.

    ``attach="title"`` (the reference's semantics) attaches ratings and
    reviews to books by title; ``attach="record"`` needs ``record_id`` in
    ``cleaned`` (``clean_records(keep_id=True)``) and attaches each to the book
    of its own record.

    ``key_order="natural"`` numbers books, ratings and reviews in the order of
    their columns (reproducible anywhere, and what the SQL checks use);
    ``"input"`` numbers them in input order, as the reference's ids did but
    dense, with no sort: on very large inputs that saves the range sort's
    sampling pass and its shuffle.  Input-order keys repeat for the same input
    files; those of reviews (a join's output) are fixed once written.
    Dimension keys are always in name order.

    ``materialize_cleaned`` writes the cleaned records once, so that the five
    builds scan columns of that table instead of each re-running the scan, the
    cleaning and the de-duplication.  ``book_buckets`` writes the books table
    bucketed by ``book_id`` and registers it in the session catalog; joins of
    the views on ``book_id`` then do not shuffle it.  ``close`` (or use as a
    context manager) deletes every written table.

    ``registry`` names a folder of key registries that outlives the star: ids of
    books and ratings go by their document, of names by the name and of reviews by book
    and document, and a later ``delivery`` gives known ones the ids they have.  Needs
    ``record_id``.  Without it ids are places in an order, and one new row moves those
    after it.
    """

    cleaned: DataFrame
    trim_genres: bool = False
    attach: str = "title"
    key_order: str = "natural"
    materialize_cleaned: bool = True
    book_buckets: int | None = None
    registry: str | None = None
    delivery: str = "first"
    _cache: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.attach not in ATTACH_KEYS:
            raise ValueError(f"attach must be one of {sorted(ATTACH_KEYS)}")
        if self.attach == "record" and "record_id" not in self.cleaned.columns:
            raise ValueError("attach='record' needs clean_records(..., keep_id=True)")
        if self.registry and "record_id" not in self.cleaned.columns:
            raise ValueError("registry needs clean_records(..., keep_id=True)")
        if self.key_order not in ("natural", "input"):
            raise ValueError("key_order must be 'natural' or 'input'")
        self._source = self.cleaned

    def __enter__(self) -> "Star":
        return self

    def __exit__(self, *exc) -> None:
        self.close()

    def close(self) -> None:
        """Delete the written tables; frames made from them cannot be read
        afterwards."""
        for item in self._cache.values():
            if isinstance(item, (Keyed, ReviewBlocks)):
                item.remove()
        if "records_path" in self._cache:
            remove_path(self._source.sparkSession, self._cache["records_path"])
        self._cache.clear()

    @property
    def records(self) -> DataFrame:
        """The cleaned records every table is built from."""
        return self._get("records", self._records) if self.materialize_cleaned else self._source

    def _records(self) -> DataFrame:
        written = materialize(self._source, "cleaned")
        self._cache["records_path"] = written.path
        return written.df

    @property
    def _ties(self) -> str:
        """Projections of the written records are scans; others are written first."""
        return "scan" if self.materialize_cleaned else "write"

    @property
    def hot_titles(self) -> DataFrame | None:
        """Titles whose m books and m records make many pairs, measured once."""
        if self.attach == "record":
            return None
        titles = lambda: self.books.df.select("book_title")
        return self._get("hot_titles", lambda: hot_pairs(titles(), titles(), "book_title"))

    @property
    def pair_tasks(self) -> int | None:
        """Tasks for a join of books and ratings by title, so that one makes about
        ``PAIRS_PER_TASK`` pairs; None where there are no more than cores."""
        if self.attach == "record":
            return None
        cores = self._source.sparkSession.sparkContext.defaultParallelism
        tasks = self._get("pair_tasks", lambda: -(-title_fan_out(self.books, self.ratings).first()["total_pairs"] // PAIRS_PER_TASK))
        return tasks if tasks > cores else None

    @property
    def attach_key(self) -> str:
        return ATTACH_KEYS[self.attach]

    def _get(self, name, fn):
        if name not in self._cache:
            self._cache[name] = fn()
        return self._cache[name]

    KEYED = ("books", "authors", "genres", "ratings")

    def build(self, *names: str) -> "Star":
        """Build the named keyed tables that are independent of each other
        (books, authors, genres, ratings) as concurrent Spark jobs: each is a
        sort, a write and a count, and small ones leave most task slots idle."""
        todo = [n for n in names if n in self.KEYED and n not in self._cache]
        if todo:
            self.records  # written once, before the builds that read it
        if len(todo) > 1:
            # the worker threads inherit the caller's job group and local
            # properties, so cancelling the caller's jobs cancels these too
            session = self._source.sparkSession
            build_one = inheritable_thread_target(session)(lambda n: getattr(self, n))
            with ThreadPoolExecutor(max_workers=len(todo)) as pool:
                for n, keyed in zip(todo, pool.map(build_one, todo)):
                    self._cache.setdefault(n, keyed)
        for n in names:
            getattr(self, n)
        return self

    def _keyed(self, table: str, rows, build, whole: bool = False) -> Keyed:
        """From the registry if there is one, else numbered by place."""
        if self.registry:
            return self._get(table, lambda: registered(rows(), table, self.registry, self.delivery, whole))
        return self._get(table, build)

    @property
    def books(self) -> Keyed:
        return self._keyed("books", lambda: books_rows(self.records),
                           lambda: build_books(self.records, self.key_order, self.book_buckets, self._ties))

    @property
    def authors(self) -> Keyed:
        return self._keyed("authors", lambda: self.records.select(F.col("author").alias("author_name")),
                           lambda: build_authors(self.records), whole=True)

    @property
    def genres(self) -> Keyed:
        return self._keyed("genres", lambda: genre_names(self.records, trim_items=self.trim_genres),
                           lambda: build_genres(self.records, self.trim_genres), whole=True)

    @property
    def ratings(self) -> Keyed:
        return self._keyed("ratings", lambda: ratings_rows(self.records), lambda: build_ratings(self.records, self.key_order, self._ties))

    @property
    def review_blocks(self) -> ReviewBlocks | None:
        """The reviews by title as the two sides of their titles; None where they go by
        record or have ids from a registry."""
        if self.attach != "title" or self.registry:
            return None
        return self._get("review_blocks", lambda: review_blocks(self.records, self.books, self.key_order, self._ties))

    @property
    def reviews(self) -> Keyed:
        if self.review_blocks:
            return self._get("reviews", lambda: titled_reviews(self.review_blocks))
        if self.registry:
            return self._get("reviews", self._registered_reviews)
        return self._get("reviews", lambda: build_reviews(self.records, self.books, self.attach, self.key_order, self.hot_titles))

    def _registered_reviews(self) -> Keyed:
        """By title from the two sides of the titles; by record, or where a registry holds
        pairs already (of reviews by record, or of before), from the pairs."""
        titles = review_registry(self.books, self.registry)
        pairs = Ledger(self._source.sparkSession, f"{self.registry.rstrip('/')}/reviews").deliveries()
        if self.attach == "record" and not pairs and titles.deliveries():
            raise ValueError("the registry holds reviews by title")
        if self.attach == "record" or pairs:
            return registered(review_rows(self.records, self.books, self.attach, self.hot_titles), "reviews", self.registry, self.delivery)
        titles.extend(self.books.df, self.delivery)
        return registered_reviews(self.records, self.books, titles)

    @property
    def book_genres(self) -> DataFrame:
        self.build("books", "genres")
        return self._get("book_genres", lambda: build_book_genres(self.books, self.genres, self.trim_genres))

    @property
    def book_ratings(self) -> DataFrame:
        self.build("books", "ratings")
        return self._get("book_ratings", lambda: build_book_ratings(self.books, self.ratings, self.attach, self.hot_titles, self.pair_tasks))
