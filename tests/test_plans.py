"""The physical plans keep the properties the design relies on: pushdown and
pruning at the scan, partial aggregation before every shuffle, no shuffle
where the partitioning is already right, broadcasts only of measured sides."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from starloom.catalog import spark_queries as sq
from starloom.plans import reports, views
from starloom.plans.star import Star

from conftest import SF01


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def shuffles(p: str) -> list[str]:
    return re.findall(r"^\(\d+\) Exchange\n(?:.*\n)*?Arguments: (\w+)", p, flags=re.M)


def test_filter_and_projection_reach_the_scan(spark):
    p = plan(sq.q_semi_filter(spark, SF01))
    assert "EqualTo(l_returnflag,R)" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in p


def test_reports_aggregate_partially_before_the_shuffle(spark):
    # duplicates are found by id before: the report has the shuffle of its counts and
    # that of the sort, and none of whole rows
    assert sorted(shuffles(plan(sq.q_report_genre_counts(spark, SF01)))) == ["hashpartitioning", "rangepartitioning"]
    p = plan(reports.genre_counts(sq.clean_records(sq.raw(spark, SF01), as_of=sq.AS_OF, dedupe="none")))
    kinds = shuffles(p)
    assert kinds == ["hashpartitioning", "rangepartitioning"]
    assert p.index("partial_count") < p.index("hashpartitioning")
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_type:string>" in p


def test_dedupe_by_key_folds_hot_keys_map_side(spark):
    p = plan(sq.q_dedupe_key(spark, SF01))
    assert p.index("partial_min") < p.index("hashpartitioning")


def test_bridge_book_genres_needs_no_shuffle(spark):
    p = plan(sq.q_bridge_book_genres(spark, SF01))
    assert shuffles(p) == []


def test_no_broadcast_of_unmeasured_sides(spark):
    # static broadcasts are off in sessions built by build_session
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    p = plan(sq.q_anti_filter(spark, SF01))
    assert "BroadcastExchange" not in p


def test_views_shuffle_no_more_than_they_need(spark):
    s = sq.star(spark, SF01).build(*Star.KEYED)
    s.hot_titles  # measured before
    assert shuffles(plan(views.books_genre_names(s))) == []
    assert "Join" not in plan(views.books_genre_names(s))
    assert shuffles(plan(views.book_rating_details(s))) == ["hashpartitioning"] * 2
    final = plan(views.books_final(s))
    assert len(shuffles(final)) == 2
    # the wide rows are scanned once, and no view joins offsets to get keys
    assert final.count("description:string") == 1
    assert "__off" not in final and "__mid" not in final


def test_filter_on_a_key_reaches_the_scan(spark):
    p = plan(sq.star(spark, SF01).books.df.filter("book_id = 7").select("book_title"))
    assert "EqualTo(book_id,7)" in p


def test_books_final_on_bucketed_books_has_no_shuffle(spark):
    with Star(sq.cleaned(spark, SF01), book_buckets=4) as s:
        p = plan(views.books_final(s))
        assert "Bucketed: true" in p
        assert shuffles(p) == []
        assert views.books_final(s).count() == 2000


HOT_SIZES = {"left": (12_000, 600), "right": (600, 12_000), "both": (3_000, 3_000)}


@pytest.mark.parametrize("side", sorted(HOT_SIZES))
@pytest.mark.parametrize("aqe_skew", ["true", "false"])
def test_hot_title_is_cut_by_its_pairs(spark, side, aqe_skew):
    """'No title' with millions of pairs, at default thresholds: no task makes
    much more than its share, no pair is lost or doubled."""
    from starloom.operators import hot_pairs
    from starloom.operators.joins import PAIRS_PER_TASK
    from starloom.plans.star import key_join

    def rows(hot, other, name):
        title = F.when(F.col("id") < hot, F.lit("No title")).otherwise(F.concat(F.lit("t"), (F.col("id") - hot).cast("string")))
        return spark.range(0, hot + other).select(title.alias("book_title"), F.col("id").alias(name))

    m, n = HOT_SIZES[side]
    left, right = rows(m, 2000, "a"), rows(n, 1000, "b")
    hot = hot_pairs(left, right, "book_title")
    (cut,) = hot.collect()
    assert cut.book_title == "No title"
    assert (m / cut["__cuts_l"]) * (n / cut["__cuts_r"]) <= PAIRS_PER_TASK
    old = spark.conf.get("spark.sql.adaptive.skewJoin.enabled")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", aqe_skew)
    try:
        for how, more in (("inner", 1000), ("left", 2000)):
            out = key_join(left, right, "book_title", how, hot)
            assert out.columns == ["book_title", "a", "b"]
            got = out.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
            plain = left.join(right, "book_title", how).agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
            assert tuple(got) == tuple(plain) and got[0] == m * n + more
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", old)


def test_pairs_below_the_limit_join_plainly(spark):
    from starloom.operators import hot_pairs

    df = spark.range(100).select(F.col("id").cast("string").alias("k"))
    assert hot_pairs(df, df, "k") is None
    assert "__cell" not in plan(sq.q_bridge_book_ratings(spark, SF01))


def test_left_join_with_cut_keys_keeps_unmatched_rows(spark):
    from starloom.operators import hot_pairs, salted_join

    title = lambda n: F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), (F.col("id") % n).cast("string")))
    left = spark.range(0, 3000).select(title(500).alias("k"), F.col("id").alias("a"))
    left = left.unionByName(spark.createDataFrame([(None, -1), ("alone", -2)], "k string, a long"))
    right = spark.range(0, 700).select(title(400).alias("k"), F.col("id").alias("b"))
    hot = hot_pairs(left, right, "k", max_pairs=300)
    assert hot.filter("__cuts_r > 1").count() > 0
    for how in ("inner", "left"):
        plain = left.join(right, "k", how)
        salted = salted_join(left, right, "k", how, hot)
        assert salted.count() == plain.count()
        assert salted.select(*plain.columns).exceptAll(plain).count() == 0
