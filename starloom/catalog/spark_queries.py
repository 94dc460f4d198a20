"""Registered Spark queries: one per operator group of the inventory.

Every query reads the generated tables under ``sf_dir`` (or data Spark derives
from them) in full, so its work grows with the tables.  Queries that write
(CSV, streaming) write below the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, numbers, text
from ..operators import (
    BatchTables,
    KeyBitmap,
    KeyRegistry,
    assign_dense_key,
    dedupe_by_key,
    drop_duplicates_by_id,
    drop_exact_duplicates,
    drop_existing,
    keep_existing,
    null_census,
    referential_counts,
    rejected_rows,
    row_count,
    schema_report,
    spread,
)
from ..plans import load as ld
from ..plans import reports, views
from ..plans.clean import clean_records, fill_report
from ..plans.export import publish_star, read_published, star_tables
from ..plans.report_state import ReportState
from ..plans.star import Star, books_rows, build_authors, build_genres, genre_names
from ..plans.title_blocks import TitleBlocks
from ..session import scratch_path
from ..sources import (
    drift_report,
    json_documents_from_part,
    raw_records_from_part,
    read_csv,
    read_csv_skip_long_lines,
    read_csv_split,
    read_table,
    read_testdata,
    scan_documents,
    write_csv,
)
from ..streaming import clean_stream_once, clean_stream_to_table
from .params import AS_OF

Query = Callable[[SparkSession, str], DataFrame]


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_records_from_part(read_testdata(spark, sf_dir, "part"))


def cleaned(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return clean_records(raw(spark, sf_dir), as_of=AS_OF, **options)


def _dealt(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """Cleaned records of a source dealt over the cores: a small file is one split, and
    one task would clean all of it."""
    part = spread(read_testdata(spark, sf_dir, "part"), spark.sparkContext.defaultParallelism)
    return clean_records(raw_records_from_part(part), as_of=AS_OF, store_repeated=False, **options)


def star(spark: SparkSession, sf_dir: str) -> Star:
    return Star(_dealt(spark, sf_dir))


def record_star(spark: SparkSession, sf_dir: str) -> Star:
    """Facts attached to the book of their own record: no title fan-out."""
    return Star(_dealt(spark, sf_dir, keep_id=True), attach="record")


# --- sources, projections, expression library --------------------------------

def q_raw_records(spark, sf_dir):
    return raw(spark, sf_dir)


def q_scan_project_rename(spark, sf_dir):
    part = read_table(spark, f"{sf_dir.rstrip('/')}/part.parquet", fmt="parquet")
    return (
        part.withColumnsRenamed({"p_partkey": "part_id", "p_name": "part_name", "p_brand": "brand",
                                 "p_type": "part_type", "p_size": "size"})
        .withColumn("source_table", F.lit("part"))
        .drop("p_retailprice")
        .select("part_id", "part_name", "brand", "part_type", "size", "source_table")
    )


def q_scan_variant_documents(spark, sf_dir):
    """SRC1 by a pinned schema over documents that drift: what does not fit is rescued."""
    docs = json_documents_from_part(read_testdata(spark, sf_dir, "part"))
    rows = scan_documents(docs, "body", "id long, name string, size int")
    shown = F.transform(F.array_sort(F.map_entries("_rescued")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return rows.select("id", "name", "size", F.array_join(shown, ";").alias("rescued"), F.col("_malformed").alias("malformed"))


def q_schema_drift_report(spark, sf_dir):
    """DQ2 over documents: the kinds of values of every field, and the kind that holds them."""
    return drift_report(json_documents_from_part(read_testdata(spark, sf_dir, "part")), "body")


def q_strip_thousands_cast(spark, sf_dir):
    return raw(spark, sf_dir).select(
        F.col("_id").alias("record_id"),
        numbers.to_float("Rating").alias("rating"),
        numbers.to_int(numbers.strip_thousands("`Number of Ratings`")).alias("num_ratings"),
        numbers.to_int(numbers.strip_thousands("Reviews")).alias("reviews"),
        numbers.to_int(numbers.strip_thousands("Score")).alias("score"),
        numbers.to_int("Pages").alias("pages"),
    )


def _order_date_text() -> "F.Column":
    """Date texts of every kind the legacy parser reads or refuses."""
    d = F.col("o_orderdate")
    first = F.lit(dates.PUBLISHED_PREFIX)
    day = lambda fmt: F.date_format(d, fmt)
    kinds = [
        F.concat(first, day("MMMM d, yyyy")),
        F.concat(first, day("yyyy")),
        F.concat(first, day("MMMM yyyy")),
        F.concat(F.lit(dates.PLACEHOLDER_DATE_PREFIX), day("MMMM d, yyyy")),
        F.concat(day("MMMM d, yyyy"), F.lit(" extra")),
        day("MMM d, yyyy"),
        day("MMM yyyy"),
        F.concat(day("MMMM"), F.lit("  "), day("d, yyyy")),
        F.concat(day("MMMM d, yyyy"), F.lit(" (ebook)")),
        F.concat(day("yyyy"), F.lit(" reissue")),
        F.concat(F.lit(" "), F.upper(day("MMMM")), day(" d, yyyy")),
        day("MMMM d yyyy"),
        F.concat(F.lit("February 30, "), day("yyyy")),
    ]
    k = F.col("o_orderkey") % len(kinds)
    out = F.when(k == 0, kinds[0])
    for i, kind in enumerate(kinds[1:], 1):
        out = out.when(k == i, kind)
    return out


def q_date_cascade(spark, sf_dir):
    orders = read_testdata(spark, sf_dir, "orders")
    txt = orders.select("o_orderkey", _order_date_text().alias("date_text"))
    return txt.select(
        "o_orderkey", "date_text",
        dates.parse_publish_date(text.remove_phrase("date_text", dates.PUBLISHED_PREFIX)).alias("publish_date"),
    )


def q_date_cascade_legacy(spark, sf_dir):
    """The cascade with both phrases removed first, so that 'Published ...'
    dates parse as well."""
    orders = read_testdata(spark, sf_dir, "orders")
    txt = orders.select("o_orderkey", _order_date_text().alias("date_text"))
    bare = text.remove_phrase(text.remove_phrase("date_text", dates.PUBLISHED_PREFIX), dates.PLACEHOLDER_DATE_PREFIX)
    return txt.select("o_orderkey", "date_text", dates.parse_publish_date(bare, prefix=True).alias("publish_date"))


def q_date_roundtrip(spark, sf_dir):
    orders = read_testdata(spark, sf_dir, "orders")
    dmy = dates.format_day_month_year("o_orderdate")
    return orders.select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("order_date"),
        dmy.alias("dmy_text"),
        dates.parse_day_month_year(dmy).alias("dmy_date"),
        dates.lenient_date(F.col("o_orderdate").cast("string")).alias("lenient_date"),
    )


def q_date_defaults(spark, sf_dir):
    base = raw(spark, sf_dir).select(
        F.col("_id").alias("record_id"),
        F.col("Date").alias("date_text"),
        text.remove_phrase("Date", dates.PUBLISHED_PREFIX).alias("cleaned_date"),
    )
    return base.select(
        "record_id",
        dates.default_date_text("date_text", AS_OF).alias("date_text"),
        dates.default_published_words("cleaned_date", AS_OF).alias("cleaned_date"),
    )


def q_text_classify(spark, sf_dir):
    docs = spread(read_testdata(spark, sf_dir, "documents"), spark.sparkContext.defaultParallelism)
    return docs.select(
        "doc_id",
        text.is_unusable_text("text").alias("unusable"),
        text.classify_text("text").alias("classified"),
    )


def q_text_clean(spark, sf_dir):
    first = text.clean_text_first_pass("Description")
    return raw(spark, sf_dir).select(
        F.col("_id").alias("record_id"),
        F.col("Description").alias("raw_text"),
        first.alias("first_pass"),
        text.clean_text_second_pass(first).alias("second_pass"),
    )


def q_text_clean_documents(spark, sf_dir):
    docs = spread(read_testdata(spark, sf_dir, "documents"), spark.sparkContext.defaultParallelism)
    return docs.select("doc_id", "lang", text.clean_text("text", passes=2).alias("cleaned_text"))


def q_clean_records(spark, sf_dir):
    return cleaned(spark, sf_dir, store_repeated=False)


def q_fill_defaults(spark, sf_dir):
    """DQ4: how many values each default replaced."""
    return fill_report(clean_records(raw(spark, sf_dir), fill=False, store_repeated=False))


def q_null_census_raw(spark, sf_dir):
    return null_census(raw(spark, sf_dir))


def q_null_census_clean(spark, sf_dir):
    return null_census(cleaned(spark, sf_dir, store_repeated=False))


EXPECTED_CLEAN_SCHEMA = T.StructType([
    T.StructField("rank", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("author", T.StringType()), T.StructField("rating", T.FloatType()),
    T.StructField("num_ratings", T.IntegerType()), T.StructField("reviews", T.IntegerType()),
    T.StructField("score", T.IntegerType()), T.StructField("pages", T.IntegerType()),
    T.StructField("cover_type", T.StringType()), T.StructField("date_text", T.StringType()),
    T.StructField("description", T.StringType()), T.StructField("genres", T.StringType()),
    T.StructField("cleaned_date", T.StringType()), T.StructField("publish_date", T.DateType()),
])


def q_schema_report(spark, sf_dir):
    return schema_report(cleaned(spark, sf_dir), EXPECTED_CLEAN_SCHEMA)


def q_dedupe_rows(spark, sf_dir):
    docs = read_testdata(spark, sf_dir, "documents")
    return drop_exact_duplicates(docs, ignore=["doc_id"])


def q_dedupe_key(spark, sf_dir):
    li = read_testdata(spark, sf_dir, "lineitem")
    return dedupe_by_key(li, ["l_orderkey"], order=["l_linenumber"])


LINEITEM_ORDER = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                  "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def q_dense_ids(spark, sf_dir):
    li = read_testdata(spark, sf_dir, "lineitem")
    return assign_dense_key(li, LINEITEM_ORDER, "row_id", ties="scan").df


def q_semi_filter(spark, sf_dir):
    orders = read_testdata(spark, sf_dir, "orders")
    returned = read_testdata(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    return keep_existing(orders, returned, "o_orderkey", parent_on="l_orderkey")


def q_anti_filter(spark, sf_dir):
    orders = read_testdata(spark, sf_dir, "orders")
    lineitem = read_testdata(spark, sf_dir, "lineitem")
    return drop_existing(orders, lineitem, "o_orderkey", existing_on="l_orderkey")


def q_semi_filter_bitmap(spark, sf_dir):
    """JOIN6 by bitmap: the parent's rows are not shuffled."""
    returned = read_testdata(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    return KeyBitmap.of(returned, "l_orderkey").keep(read_testdata(spark, sf_dir, "orders"), "o_orderkey")


def q_anti_filter_bitmap(spark, sf_dir):
    """JOIN7 by bitmap, of two deliveries' bitmaps joined."""
    lineitem = read_testdata(spark, sf_dir, "lineitem")
    parts = [KeyBitmap.of(lineitem.filter(F.col("l_linenumber") > 1), "l_orderkey"), KeyBitmap.of(lineitem.filter(F.col("l_linenumber") <= 1), "l_orderkey")]
    return KeyBitmap.union(*parts).drop(read_testdata(spark, sf_dir, "orders"), "o_orderkey")


def q_dedupe_by_id(spark, sf_dir):
    """AGG7 by id first: part, with exact copies of some rows and rows that share an id only."""
    part = read_testdata(spark, sf_dir, "part")
    copies = part.filter(F.col("p_partkey") % 7 == 0)
    changed = part.filter(F.col("p_partkey") % 11 == 0).withColumn("p_name", F.concat("p_name", F.lit(" 2")))
    return drop_duplicates_by_id(part.unionByName(copies).unionByName(changed), "p_partkey")


# --- ids over several deliveries ------------------------------------------------

def _delivered(spark, sf_dir, name: str) -> DataFrame:
    """Cleaned records of the first delivery (two thirds of the parts) or of the
    second, which brings all of them."""
    rows = raw_records_from_part(spread(read_testdata(spark, sf_dir, "part"), spark.sparkContext.defaultParallelism))
    if name == "first":
        rows = rows.filter(F.col("Rank").cast("long") % 3 != 0)
    return clean_records(rows, as_of=AS_OF, keep_id=True, store_repeated=False)


def q_keys_two_deliveries(spark, sf_dir):
    """KEY1, KEY3 by registry: genres and books of two deliveries, the second
    extending the first, with the delivery each id came with."""
    out = None
    for kind, column, rows_of in (("genre", "genre_name", lambda d: genre_names(d)), ("book", "record_id", lambda d: d.select("record_id"))):
        registry = KeyRegistry(spark, scratch_path(spark, f"registry-{kind}"), f"{column} string", "id")
        made = [registry.extend(rows_of(_delivered(spark, sf_dir, d)), d) for d in ("first", "second")]
        registry.extend(rows_of(_delivered(spark, sf_dir, "second")), "second")  # once more: adds nothing
        rows = registry.keys().select(F.lit(kind).alias("kind"), F.col(column).alias("natural_key"), "id",
                                      F.when(F.col("id") < made[1].first, "first").otherwise("second").alias("delivery"))
        out = rows if out is None else out.unionByName(rows)
    return out


def q_load_books_incremental(spark, sf_dir):
    """LD2 over two deliveries: what each appends, ids of the first unmoved."""
    registry = KeyRegistry(spark, scratch_path(spark, "registry-books"), "record_id string", "book_id")
    loads = [ld.prepare_books(ld.increment(books_rows(_delivered(spark, sf_dir, d)), registry, d), drop_key=False).withColumn("delivery", F.lit(d))
             for d in ("first", "second")]
    return loads[0].unionByName(loads[1])


def q_reviews_two_deliveries(spark, sf_dir):
    """JOB7 with ids from a registry: the reviews of the second delivery's star; those
    of pairs that the first had keep their ids."""
    path = scratch_path(spark, "registries")
    for delivery in ("first", "second"):
        s = Star(_delivered(spark, sf_dir, delivery), registry=path, delivery=delivery)
        rows = s.reviews.df
    return rows


# --- star schema ----------------------------------------------------------------

def q_clean_books(spark, sf_dir):
    return star(spark, sf_dir).books.df


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned records with their duplicates: a dimension is a set of names, so one
    built alone needs no de-duplication, and reads its one column."""
    return cleaned(spark, sf_dir, dedupe="none")


def q_dim_authors(spark, sf_dir):
    return build_authors(names(spark, sf_dir)).df


def q_dim_genres(spark, sf_dir):
    return build_genres(names(spark, sf_dir)).df


def q_bridge_book_genres(spark, sf_dir):
    return star(spark, sf_dir).book_genres


def q_fact_ratings(spark, sf_dir):
    return star(spark, sf_dir).ratings.df


def q_fact_reviews(spark, sf_dir):
    return star(spark, sf_dir).reviews.df


def q_bridge_book_ratings(spark, sf_dir):
    return star(spark, sf_dir).book_ratings


def q_bridge_valid_count(spark, sf_dir):
    """DQ3 on the bridge: pairs with both parents, and pairs without, from the counts
    of either side."""
    s = star(spark, sf_dir).build("books", "ratings")
    return TitleBlocks.of(s.books, s.ratings).pair_count()


def q_title_pair_report(spark, sf_dir):
    """Per title the pairs of the bridge and sums over them, no pair made."""
    s = star(spark, sf_dir).build("books", "ratings")
    return TitleBlocks.of(s.books, s.ratings).pair_sums({"sum_pages": "num_pages"}, {"sum_num_ratings": "num_ratings", "sum_score": "score"})


def q_bridge_expanded(spark, sf_dir):
    """The bridge of JOB8, expanded from its blocks."""
    s = star(spark, sf_dir).build("books", "ratings")
    return TitleBlocks.of(s.books, s.ratings).expanded()


def _some_parents(spark, sf_dir):
    """Parts and orders, a share of each missing, so that line items are orphans."""
    part = read_testdata(spark, sf_dir, "part").filter("p_size <= 40").select(F.col("p_partkey").alias("l_partkey"))
    orders = read_testdata(spark, sf_dir, "orders").filter("o_orderkey % 7 <> 0").select(F.col("o_orderkey").alias("l_orderkey"))
    return part, orders


def q_referential_orphans(spark, sf_dir):
    """DQ3 where parents are missing: rows with both parents, and the rest."""
    part, orders = _some_parents(spark, sf_dir)
    return referential_counts(read_testdata(spark, sf_dir, "lineitem"), {"l_partkey": part, "l_orderkey": orders})


def q_rejected_orphans(spark, sf_dir):
    """The rows a referential filter rejects."""
    part, _ = _some_parents(spark, sf_dir)
    return rejected_rows(read_testdata(spark, sf_dir, "lineitem"), part, "l_partkey")


def q_reviews_by_record(spark, sf_dir):
    return record_star(spark, sf_dir).reviews.df


def q_bridge_book_ratings_by_record(spark, sf_dir):
    return record_star(spark, sf_dir).book_ratings


def q_books_left_ratings_by_record(spark, sf_dir):
    return views.books_left_ratings(record_star(spark, sf_dir))


def q_books_left_ratings(spark, sf_dir):
    return views.books_left_ratings(star(spark, sf_dir))


def q_ratings_left_books(spark, sf_dir):
    return views.ratings_left_books(star(spark, sf_dir))


def q_books_ratings_wide(spark, sf_dir):
    return views.books_ratings_wide(star(spark, sf_dir))


def q_book_rating_details(spark, sf_dir):
    return views.book_rating_details(star(spark, sf_dir))


def q_books_genre_names(spark, sf_dir):
    return views.books_genre_names(star(spark, sf_dir))


def q_books_reviews(spark, sf_dir):
    return views.books_reviews(star(spark, sf_dir))


def q_books_final(spark, sf_dir):
    return views.books_final(star(spark, sf_dir))


# --- reports ------------------------------------------------------------------------

def q_report_author_counts(spark, sf_dir):
    return reports.author_counts(cleaned(spark, sf_dir))


def q_report_genre_counts(spark, sf_dir):
    return reports.genre_counts(cleaned(spark, sf_dir))


def q_report_title_ratings(spark, sf_dir):
    # rounded for the comparison only, after the report is made and sorted
    return reports.title_ratings(cleaned(spark, sf_dir)).withColumn("average_rating", F.round("average_rating", 6))


def q_report_top20(spark, sf_dir):
    return reports.top_authors(cleaned(spark, sf_dir), 20)


# --- CSV sinks and sources --------------------------------------------------------------

BOOKS_CSV_SCHEMA = T.StructType([
    T.StructField("book_id", T.LongType()), T.StructField("book_title", T.StringType()),
    T.StructField("author_id", T.LongType()), T.StructField("num_pages", T.IntegerType()),
    T.StructField("cover_type", T.StringType()), T.StructField("publish_date", T.DateType()),
    T.StructField("description", T.StringType()), T.StructField("genre_ids", T.StringType()),
])


def _books_csv(spark, sf_dir) -> str:
    path = scratch_path(spark, "books-csv")
    write_csv(views.books_final(star(spark, sf_dir)), path, quoting="exact")
    return path


def q_csv_roundtrip(spark, sf_dir):
    return read_csv(spark, _books_csv(spark, sf_dir), BOOKS_CSV_SCHEMA)


def q_csv_split_roundtrip(spark, sf_dir):
    """SRC3 at size: one large file whose values hold line ends and quotes, read in splits
    by several tasks."""
    path = scratch_path(spark, "books-csv-one")
    write_csv(views.books_final(star(spark, sf_dir)), path, quoting="exact", single_file=True)
    return read_csv_split(spark, path, BOOKS_CSV_SCHEMA)


SKIP_SCHEMA = T.StructType([T.StructField("record_id", T.StringType()), T.StructField("title", T.StringType()),
                            T.StructField("genres", T.StringType())])


def q_csv_skip_bad(spark, sf_dir):
    """Lines written without quoting, as a naive writer does: a genre list
    with commas spills into surplus fields, and exactly those lines are
    skipped on read (SRC4)."""
    fields = [F.coalesce(F.col(c), F.lit("")) for c in ("_id", "Title", "Genres")]
    path = scratch_path(spark, "naive-csv")
    raw(spark, sf_dir).select(F.concat_ws(",", *fields).alias("value")).write.text(path)
    return read_csv_skip_long_lines(spark, path, SKIP_SCHEMA, header=False)


def q_export_star(spark, sf_dir):
    """EXP1, SNK2, PAR1: all seven tables published as single files, then again as the
    next generation; rows and data files of each as read back by the manifest."""
    s = star(spark, sf_dir)
    out = scratch_path(spark, "export-star")
    for _ in range(2):
        publish_star(s, out, single_file=True, compression="gzip")
    schemas = {name: df.schema for name, df in star_tables(s).items()}
    frames = []
    for name, back in sorted(read_published(spark, out, schemas).items()):
        rows = row_count(back, table_name=name)
        files = back.select(F.input_file_name().alias("f")).distinct().agg(F.count(F.lit(1)).alias("files"))
        frames.append(rows.join(files))  # one row with one row
    out_df = frames[0]
    for f in frames[1:]:
        out_df = out_df.unionByName(f)
    return out_df


def q_export_census(spark, sf_dir):
    """DQ1, AGG5 in the write pass: rows and nulls per column of every exported table."""
    census: dict = {}
    publish_star(star(spark, sf_dir), scratch_path(spark, "export-census"), census=census, compression="gzip")
    rows = [(table, name[6:], found["rows"], n) for table, found in census.items() for name, n in found.items() if name != "rows"]
    return spark.createDataFrame(rows, "table_name string, column_name string, row_count long, null_count long")


# --- loads (prepared rows; the JDBC write itself is a thin sink) ------------------------------------

def q_load_authors(spark, sf_dir):
    """LD1: the authors export read back."""
    path = _exported(spark, build_authors(names(spark, sf_dir)).df, "authors")
    return ld.prepare_authors(read_csv(spark, path, "author_id long, author_name string"))


BOOKS_TEXT_DATES = T.StructType([T.StructField(f.name, T.StringType() if f.name == "publish_date" else f.dataType)
                                 for f in BOOKS_CSV_SCHEMA])


def q_load_books(spark, sf_dir):
    """LD2: the books export read back with its dates as text, some of them
    spoiled on the way; descriptions may hold line ends."""
    books = read_csv_skip_long_lines(spark, _books_csv(spark, sf_dir), BOOKS_TEXT_DATES, multi_line=True)
    spoiled = F.when(F.col("book_id") % 13 == 0, F.concat(F.lit("2024-02-3"), F.substring("publish_date", 10, 1)))
    spoiled = spoiled.when(F.col("book_id") % 17 == 0, F.lit("unknown"))
    return ld.prepare_books(books.withColumn("publish_date", spoiled.otherwise(F.col("publish_date"))))


def _exported(spark, df: DataFrame, name: str, times: int = 1, compression: str | None = None) -> str:
    """Export a star table as CSV (EXP1), ``times`` runs appending to one
    folder, and return the folder; the loads read it back as the reference's
    loader read its CSV files."""
    path = scratch_path(spark, f"export-{name}")
    for _ in range(times):
        write_csv(df, path, mode="append", compression=compression)
    return path


RATINGS_CSV_SCHEMA = T.StructType([
    T.StructField("book_title", T.StringType()), T.StructField("rating", T.FloatType()),
    T.StructField("num_ratings", T.IntegerType()), T.StructField("num_reviews", T.IntegerType()),
    T.StructField("score", T.IntegerType()), T.StructField("rating_id", T.LongType()),
])


def q_load_ratings(spark, sf_dir):
    """LD3: the ratings export was appended twice (duplicate keys), and the
    ratings without a count were loaded before; read with bad-line skipping
    (SRC4), one row per key, new keys only."""
    s = star(spark, sf_dir)
    ratings = s.ratings.df.select(*[f.name for f in RATINGS_CSV_SCHEMA.fields])
    exported = read_csv_skip_long_lines(spark, _exported(spark, ratings, "ratings", times=2), RATINGS_CSV_SCHEMA,
                                        multi_line=True)  # titles are free text
    loaded_before = ratings.filter(F.col("num_ratings") == 0).select("rating_id")
    return ld.prepare_ratings(exported, loaded_before)


def q_load_reviews(spark, sf_dir):
    """LD4/LD5: the reviews export read back (SRC3), rows with a parent book."""
    s = star(spark, sf_dir)
    path = _exported(spark, s.reviews.df, "reviews", compression="gzip")
    reviews = read_csv(spark, path, "review_id long, book_id long, reviews int, score int", multi_line=False)
    return ld.prepare_reviews(reviews, s.books.df.select("book_id"))


def q_load_reviews_orphans(spark, sf_dir):
    """LD4/LD5 where some books are not loaded: their reviews stay out."""
    s = star(spark, sf_dir)
    path = _exported(spark, s.reviews.df, "reviews", compression="gzip")
    reviews = read_csv(spark, path, "review_id long, book_id long, reviews int, score int", multi_line=False)
    return ld.prepare_reviews(reviews, s.books.df.filter("cover_type <> 'Hardcover'").select("book_id"))


def q_load_book_genres(spark, sf_dir):
    """LD6: the bridge export read back, pairs whose genre exists."""
    s = star(spark, sf_dir)
    pairs = read_csv(spark, _exported(spark, s.book_genres, "book_genres"), "book_id long, genre_id long", multi_line=False)
    return ld.prepare_book_genres(pairs, s.genres.df.select("genre_id"))


def q_load_book_genres_orphans(spark, sf_dir):
    """LD6 where some genres are not loaded: their pairs stay out."""
    s = star(spark, sf_dir)
    pairs = read_csv(spark, _exported(spark, s.book_genres, "book_genres"), "book_id long, genre_id long", multi_line=False)
    return ld.prepare_book_genres(pairs, s.genres.df.filter("genre_name NOT LIKE ' %'").select("genre_id"))


def q_load_book_ratings(spark, sf_dir):
    """LD7: the bridge export read back, renumbered, both parents checked."""
    s = star(spark, sf_dir)
    pairs = read_csv(spark, _exported(spark, s.book_ratings, "book_ratings", compression="gzip"), "book_id long, rating_id long", multi_line=False)
    return ld.prepare_book_ratings(pairs, s.ratings.df.select("rating_id"), s.books.df.select("book_id"))


# --- streaming ------------------------------------------------------------------------------------

def q_stream_clean(spark, sf_dir):
    return clean_stream_to_table(spark, sf_dir, "part.parquet", as_of=AS_OF, within="1 hour")


def q_stream_clean_twice(spark, sf_dir):
    """JOB1 on a stream over all time: a second delivery of the same files, as another
    stream into the same folder, adds nothing."""
    out = scratch_path(spark, "stream-once")
    for delivery in ("first", "second"):
        tables = clean_stream_once(spark, sf_dir, out, delivery, "part.parquet", as_of=AS_OF)
    return tables.read("cleaned", cleaned(spark, sf_dir, dedupe="none").schema)


# --- state over batches ------------------------------------------------------------------------

def q_append_twice(spark, sf_dir):
    """SNK4 with a ledger: three batches of line items, the second delivered twice and the
    third taken back."""
    tables = BatchTables(spark, scratch_path(spark, "appends"))
    lineitem = read_testdata(spark, sf_dir, "lineitem")
    parts = {f"batch-{i}": lineitem.filter(F.col("l_orderkey") % 3 == i) for i in range(3)}
    for name in ("batch-0", "batch-1", "batch-1", "batch-2", "batch-0"):
        tables.append(name, {"lineitem": parts[name]})
    tables.retract("batch-2")
    return tables.read("lineitem", lineitem.schema, "batch")


def q_report_two_deliveries(spark, sf_dir):
    """REP1-REP3 from the partial states of two deliveries, as one table."""
    state = ReportState(spark, scratch_path(spark, "report-state"))
    rows = raw(spark, sf_dir)
    old = F.col("Rank").cast("long") % 3 != 0
    for name, part in (("first", rows.filter(old)), ("wrong", rows.filter(old)), ("second", rows.filter(~old))):
        state.add(name, clean_records(part, as_of=AS_OF, store_repeated=False))
    state.retract("wrong")
    none = lambda kind: F.lit(None).cast(kind)
    counts = [state.author_counts().select(F.lit("author").alias("report"), F.col("author_name").alias("name"), "book_count",
                                           none("double").alias("average_rating"), none("long").alias("total_ratings"), none("long").alias("total_reviews")),
              state.genre_counts().select(F.lit("genre"), "genre_name", "book_count", none("double"), none("long"), none("long")),
              state.title_ratings().select(F.lit("title"), "book_title", none("long"), F.round("average_rating", 6), "total_ratings", "total_reviews")]
    return counts[0].union(counts[1]).union(counts[2])


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


__all__ = ["QUERIES", "queries"]
