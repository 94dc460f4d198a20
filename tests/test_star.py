"""The star schema on sf0.01: counts checked by hand in FIXTURES §4 and
invariants (dense unique keys, no orphans, report totals)."""

import pytest
from pyspark.sql import functions as F

from starloom.catalog import spark_queries as sq
from starloom.plans import reports, views
from starloom.plans.star import Star

from conftest import SF01


@pytest.fixture(scope="module")
def star(spark):
    return sq.star(spark, SF01)


def test_cleaning_counts(spark):
    c0 = sq.clean_records(sq.raw(spark, SF01), fill=False)
    assert c0.filter("pages IS NULL").count() == 66
    assert c0.filter("num_ratings IS NULL").count() == 50
    assert c0.filter("publish_date = DATE'1900-01-01'").count() == 733
    first = c0.filter(F.col("description") == "No description available").count()
    assert first == 1000
    books = sq.star(spark, SF01).books.df
    assert books.filter(F.col("description") == "No description available").count() == 1400


def test_dimensions(star):
    assert star.authors.rows == 26
    assert star.genres.rows == 45
    assert star.books.rows == 2000
    assert star.ratings.rows == 2000


def test_title_fan_out_and_bridges(star):
    assert star.reviews.rows == 2878
    assert star.book_ratings.count() == 2878
    assert star.book_genres.count() == 5582
    assert star.book_genres.distinct().count() == 5582


def test_keys_dense_and_unique(star):
    for keyed in (star.books, star.authors, star.genres, star.ratings, star.reviews):
        agg = keyed.df.agg(F.min(keyed.key), F.max(keyed.key), F.countDistinct(keyed.key), F.count("*")).first()
        assert tuple(agg) == (0, keyed.rows - 1, keyed.rows, keyed.rows)


def test_no_orphans(star):
    bg = star.book_genres
    assert bg.join(star.books.df, "book_id", "left_anti").count() == 0
    assert bg.join(star.genres.df, "genre_id", "left_anti").count() == 0
    br = star.book_ratings
    assert br.join(star.ratings.df, "rating_id", "left_anti").count() == 0


def test_report_totals(spark, star):
    cleaned = star.cleaned
    exploded = cleaned.select(F.explode(F.split("genres", ",")).alias("g")).count()
    assert reports.genre_counts(cleaned).agg(F.sum("book_count")).first()[0] == exploded
    assert reports.author_counts(cleaned).agg(F.sum("book_count")).first()[0] == 2000
    final = views.books_final(star, genre_ids_as_text=False)
    assert final.select(F.sum(F.size("genre_ids"))).first()[0] == exploded


def test_trimmed_genres_option(spark):
    s = Star(sq.cleaned(spark, SF01), trim_genres=True)
    assert s.genres.rows == 23


def test_attach_by_record_has_no_fan_out(spark):
    cleaned = sq.clean_records(sq.raw(spark, SF01), as_of=sq.AS_OF, keep_id=True)
    s = Star(cleaned, attach="record")
    assert s.reviews.rows == 2000
    br = s.book_ratings
    assert br.count() == 2000
    # each book pairs with the rating of its own record
    joined = (br.join(s.books.df.select("book_id", "record_id"), "book_id")
                .join(s.ratings.df.select("rating_id", F.col("record_id").alias("r")), "rating_id"))
    assert joined.filter(F.col("record_id") != F.col("r")).count() == 0
    assert views.books_left_ratings(s).count() == 2000


def test_input_order_keys_are_dense_and_consistent(spark):
    s = Star(sq.cleaned(spark, SF01), key_order="input")
    for keyed in (s.books, s.ratings, s.reviews):
        agg = keyed.df.agg(F.min(keyed.key), F.max(keyed.key), F.countDistinct(keyed.key)).first()
        assert tuple(agg) == (0, keyed.rows - 1, keyed.rows)
    assert s.reviews.rows == 2878
    assert s.book_ratings.count() == 2878
    # same content as the natural-order star, only the numbering differs
    natural = sq.star(spark, SF01)
    assert s.books.df.drop("book_id").exceptAll(natural.books.df.drop("book_id")).count() == 0
    assert views.books_final(s).drop("book_id").exceptAll(views.books_final(natural).drop("book_id")).count() == 0


def test_documents_delivered_twice_count_once(spark):
    raw = sq.raw(spark, SF01)
    parts = spark.read.parquet(f"{SF01}/part.parquet").count()
    assert raw.count() == parts + parts // 50
    assert sq.cleaned(spark, SF01).count() == parts
    twice = sq.clean_records(raw.unionByName(raw), as_of=sq.AS_OF)
    assert twice.exceptAll(sq.cleaned(spark, SF01)).count() == 0
    assert sq.clean_records(raw, dedupe="none").count() == raw.count()


def test_close_removes_what_was_written(spark):
    import os

    with Star(sq.cleaned(spark, SF01)) as s:
        s.build(*Star.KEYED)
        paths = [s.books.path, s.authors.path, s.reviews.path, s._cache["records_path"]]
        local = [p.removeprefix("file:") for p in paths]
        assert all(os.path.isdir(p) for p in local)
    assert not any(os.path.exists(p) for p in local)


def test_report_order(spark):
    """REP1-REP3 come out in their full order: descending, ties by name."""
    cleaned = sq.cleaned(spark, SF01)
    for report, by, name in ((reports.author_counts(cleaned), "book_count", "author_name"),
                             (reports.genre_counts(cleaned), "book_count", "genre_name"),
                             (reports.title_ratings(cleaned), "average_rating", "book_title")):
        rows = [(-r[by], r[name]) for r in report.collect()]
        assert rows == sorted(rows)
    averages = [r.average_rating for r in reports.title_ratings(cleaned).collect()]
    assert any(round(a, 6) != a for a in averages)  # not rounded before sorting


def test_materialized_records_give_the_same_star(spark):
    forced = Star(sq.cleaned(spark, SF01))
    plain = Star(sq.cleaned(spark, SF01), materialize_cleaned=False)
    files = forced.records.inputFiles()
    assert files and all("/cleaned-" in f and f.endswith(".parquet") for f in files)
    assert forced.books.df.exceptAll(plain.books.df).count() == 0
    assert forced.reviews.df.exceptAll(plain.reviews.df).count() == 0


def test_title_fan_out_predicts_the_join_size(star):
    from starloom.plans.star import title_fan_out

    r = title_fan_out(star.books, star.ratings).first()
    assert r.total_pairs == star.book_ratings.count() == 2878
    assert r.shared_titles == 1771
    assert r.max_title_pairs == max(
        row["c"] ** 2 for row in star.books.df.groupBy("book_title").agg(F.count("*").alias("c")).collect())


def test_fill_report_counts(spark):
    r = sq.q_fill_defaults(spark, SF01).first()
    assert (r.pages_filled, r.num_ratings_filled) == (66, 50)
    assert r.description_filled == 0  # text cleaning already replaced missing text


def _parts(spark, tmp_path, n=60):
    rows = [(k, f"name {k % 3}", "Brand#1", "SMALL", k % 50, float(k)) for k in range(1, n + 1)]
    columns = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    spark.createDataFrame(rows, columns).coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    return str(tmp_path)


def test_source_of_a_star_is_dealt_over_the_cores(spark, tmp_path):
    """One small file is one split, which one task would clean."""
    at = _parts(spark, tmp_path)
    for made in (sq.star(spark, at), sq.record_star(spark, at)):
        assert "RoundRobinPartitioning" in made.cleaned._jdf.queryExecution().executedPlan().toString()
        assert made.cleaned.count() == 60


def test_tasks_of_a_title_join_go_by_its_pairs(spark, tmp_path, monkeypatch):
    import starloom.plans.star as st

    at = _parts(spark, tmp_path)
    views_of = (views.books_ratings_wide, views.books_left_ratings, views.ratings_left_books, views.book_rating_details, lambda s: s.book_ratings)
    before = [sorted(map(str, v(sq.star(spark, at)).collect())) for v in views_of]
    monkeypatch.setattr(st, "PAIRS_PER_TASK", 50)
    made = sq.star(spark, at)
    assert made.pair_tasks == -(-len(before[-1]) // 50) > 4
    for v, rows in zip(views_of, before):
        out = v(made)
        assert f", {made.pair_tasks}), REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, out.collect())) == rows
