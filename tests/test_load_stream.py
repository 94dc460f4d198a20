"""Load preparation (LD3, LD7) and the streaming cleaning."""

from starloom.catalog import spark_queries as sq
from starloom.plans import load as ld

from conftest import SF001


def test_prepare_ratings_dedupes_and_skips_loaded(spark):
    r = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c")], "rating_id long, book_title string")
    loaded = spark.createDataFrame([(3,)], "rating_id long")
    out = ld.prepare_ratings(r, loaded)
    assert sorted(map(tuple, out.collect())) == [(1, "a"), (2, "b")]
    # rerun against everything loaded: nothing left to insert
    assert ld.prepare_ratings(r, r.select("rating_id")).count() == 0


def test_prepare_book_ratings_renumber_quirk(spark):
    pairs = spark.createDataFrame([(0, 5), (0, 9), (1, 5), (2, 0)], "book_id long, rating_id long")
    ratings = spark.createDataFrame([(0,), (1,), (2,), (3,)], "rating_id long")
    books = spark.createDataFrame([(0,), (1,)], "book_id long")
    out = ld.prepare_book_ratings(pairs, ratings, books)
    # renumbered 1..4 in (book_id, old id) order; 4 has no rating, book 2 no book
    assert sorted(map(tuple, out.collect())) == [(0, 1), (0, 2), (1, 3)]
    kept = ld.prepare_book_ratings(pairs, ratings, books, renumber_ids=False)
    assert sorted(map(tuple, kept.collect())) == []


def test_stream_clean_equals_batch(spark):
    streamed = sq.q_stream_clean(spark, SF001)
    batch = sq.q_clean_records(spark, SF001)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def test_stream_restart_is_exactly_once(spark):
    import tempfile

    from starloom.streaming import clean_stream_to_table

    out = tempfile.mkdtemp(prefix="starloom-stream-")
    first = clean_stream_to_table(spark, SF001, "part.parquet", out_path=out).count()
    # a restart with the same checkpoint finds nothing new and adds no rows
    second = clean_stream_to_table(spark, SF001, "part.parquet", out_path=out).count()
    parts = spark.read.parquet(f"{SF001}/part.parquet").count()
    assert first == second == parts + parts // 50  # without a time to look back, copies stay


def test_stream_bounds_are_the_callers(spark):
    from starloom.streaming import clean_stream_to_table

    parts = spark.read.parquet(f"{SF001}/part.parquet").count()
    assert clean_stream_to_table(spark, SF001, "part.parquet", within="10 minutes", max_files=1).count() == parts
