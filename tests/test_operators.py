"""Keys, de-duplication, membership and quality operators."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators import (
    assign_dense_key,
    dedupe_by_key,
    drop_exact_duplicates,
    drop_existing,
    keep_existing,
    null_census,
    null_census_tall,
    rejected_rows,
    renumber,
    top_k,
)

from conftest import SF01


def test_dense_key_matches_row_number_under_any_partitioning(spark):
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    expected = orders.withColumn(
        "k", F.row_number().over(Window.orderBy("o_orderdate", "o_orderkey")) - 1
    ).select("k", "o_orderkey")
    exp = sorted(map(tuple, expected.collect()))
    for parts in (1, 3, 7):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        keyed = assign_dense_key(orders.repartition(parts), ["o_orderdate", "o_orderkey"], "k")
        assert keyed.rows == 15000
        got = sorted(map(tuple, keyed.df.select("k", "o_orderkey").collect()))
        assert got == exp
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_keyed_membership_is_range(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    keyed = assign_dense_key(df, ["name"], "id")
    assert sorted(map(tuple, keyed.df.collect())) == [(0, "a"), (1, "b"), (2, "c")]
    probe = spark.createDataFrame([(0,), (2,), (3,), (-1,), (None,)], "id bigint")
    assert sorted(r.id for r in keep_existing(probe, keyed, "id").collect()) == [0, 2]
    assert sorted((r.id for r in drop_existing(probe, keyed, "id").collect()), key=str) == [-1, 3, None]
    assert sorted((r.id for r in rejected_rows(probe, keyed, "id").collect()), key=str) == [-1, 3, None]
    # per row: null bitmap word + two 8-byte slots + one char padded to 8 bytes
    assert keyed.data_bytes == 3 * (8 + 16 + 8)


def test_renumber_from_one(spark):
    df = spark.createDataFrame([(5, 10), (5, 3), (1, 7)], "book_id long, rating_id long")
    out = renumber(df, ["book_id"], "rating_id", start=1).df
    assert out.columns == ["book_id", "rating_id"]
    assert sorted(map(tuple, out.collect())) == [(1, 1), (5, 2), (5, 3)]


def test_semi_anti_never_multiply(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert sorted(r.k for r in keep_existing(df, parent, "k").collect()) == [1, 2]
    assert [r.k for r in drop_existing(df, parent, "k").collect()] == [3]


def test_dedupe_by_key_first_by_order_with_hot_key(spark):
    rows = [(0, i % 5, f"v{i:04d}") for i in range(3000)] + [(k, 1, "x") for k in range(1, 50)]
    df = spark.createDataFrame(rows, "k int, o int, v string")
    got = {r.k: (r.o, r.v) for r in dedupe_by_key(df, ["k"], ["o"]).collect()}
    assert got[0] == (0, "v0000")
    assert len(got) == 50


def test_drop_exact_duplicates_ignoring_id(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, t string")
    assert sorted(r.t for r in drop_exact_duplicates(df, ignore=["id"]).collect()) == ["a", "b"]
    kept = drop_exact_duplicates(df, ignore=["id"], keep_ignored=True)
    assert sorted(map(tuple, kept.collect())) == [(1, "a"), (3, "b")]
    assert drop_exact_duplicates(df).count() == 3


def test_null_census(spark):
    df = spark.createDataFrame([(None, "x"), (1, None), (None, None)], "a int, `b c` string")
    assert tuple(null_census(df).first()) == (2, 2)
    tall = {r.column_name: r.null_count for r in null_census_tall(df).collect()}
    assert tall == {"a": 2, "b c": 2}


def test_top_k_orders_nan_first_nulls_last(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", float("nan")), ("d", 1.0)], "n string, v double")
    assert [r.n for r in top_k(df, "v", 3, ["n"]).collect()] == ["c", "a", "d"]


def test_dense_key_spreads_a_hot_value(spark):
    from pyspark.sql import functions as F

    # a third of the rows share one value: they must not all sort in one task
    df = spark.range(0, 30000).select((F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))).alias("v"))
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    # one task per sorted file, so that the keyed table shows how the sort dealt
    old = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    try:
        keyed = assign_dense_key(df, ["v"], "k")
        # the sorted hot rows lie in several files of the keyed table
        per_file = keyed.df.filter("v = 7").groupBy(F.input_file_name().alias("f")).count().collect()
        assert len(per_file) >= 2
        assert max(r["count"] for r in per_file) < 10000
        agg = keyed.df.agg(F.min("k"), F.max("k"), F.countDistinct("k")).first()
        assert tuple(agg) == (0, 29999, 30000)
        hot = keyed.df.filter("v = 7").agg(F.min("k"), F.max("k"), F.count("*")).first()
        # the 10,001 sevens (every third id, and id 7) take consecutive keys
        # right after the four smaller values 1, 2, 4, 5
        assert tuple(hot) == (4, 10004, 10001)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.files.openCostInBytes", old)


def test_bucketed_keyed_table_joins_without_shuffling_it(spark):
    import contextlib
    import io

    from pyspark.sql import functions as F

    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("v"), F.lit("x").alias("pad"))
    keyed = assign_dense_key(df, ["v"], "k", buckets=5)
    assert keyed.rows == 5000
    assert sorted(r.k for r in keyed.df.select("k").collect()) == list(range(5000))
    other = spark.range(0, 5000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("w"))
    joined = keyed.df.join(other, "k")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        joined.explain(mode="formatted")
    plan = buf.getvalue()
    assert "Bucketed: true" in plan
    # only the other side is shuffled
    import re

    assert len(re.findall(r"^\(\d+\) Exchange", plan, flags=re.M)) == 1
    assert joined.count() == 5000
    keyed.remove()
    assert not spark.catalog.tableExists(keyed.table)


def test_referential_counts_with_keyed_and_plain_parents(spark):
    from starloom.operators import referential_counts

    parent = assign_dense_key(spark.createDataFrame([("a",), ("b",)], "n string"), ["n"], "pid")
    other = spark.createDataFrame([(10,), (10,), (11,)], "oid int")
    df = spark.createDataFrame([(0, 10), (1, 12), (5, 11), (None, 10)], "pid long, oid int")
    got = referential_counts(df, {"pid": parent, "oid": other}).first()
    assert (got.valid_rows, got.rejected_rows) == (1, 3)


def test_dense_key_in_input_order_without_shuffle(spark):
    from pyspark.sql import functions as F

    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    keyed = assign_dense_key(li, [], "row_id")
    assert keyed.rows == 60000
    agg = keyed.df.agg(F.min("row_id"), F.max("row_id"), F.countDistinct("row_id")).first()
    assert tuple(agg) == (0, 59999, 60000)
    # same rows, and a single-file input keeps the file's row order
    assert keyed.df.drop("row_id").exceptAll(li).count() == 0
    firsts = [tuple(r) for r in li.limit(5).collect()]
    head = [tuple(r)[1:] for r in keyed.df.filter("row_id < 5").orderBy("row_id").collect()]
    assert head == firsts


def test_broadcast_budget_and_measured_broadcast(spark):
    from starloom.operators import broadcast_budget, maybe_broadcast

    old = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "2MB")
        assert broadcast_budget(spark) == 2 << 20
        small = spark.range(10)
        assert maybe_broadcast(small, 1000) is not small  # wrapped in a broadcast hint
        assert maybe_broadcast(small, 3 << 20) is small
        assert maybe_broadcast(small, None) is small  # unmeasured: never broadcast
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        assert broadcast_budget(spark) == -1
        assert maybe_broadcast(small, 1) is small
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old)


def test_key_of_a_join_is_written_before_it_is_sorted(spark):
    """The rows of a shuffle have no fixed order: they are written first, then
    numbered from the written order, and the scratch copies are gone."""
    import os

    a = spark.range(0, 3000).select((F.col("id") % 5).alias("k"), F.lit("x").alias("v"))
    pairs = a.join(spark.range(0, 5).select(F.col("id").alias("k")), "k")
    keyed = assign_dense_key(pairs, ["k", "v"], "n")
    assert tuple(keyed.df.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()) == (0, 2999, 3000)
    base = os.path.dirname(keyed.path.removeprefix("file:"))
    assert not [f for f in os.listdir(base) if f.startswith(("rows-n-", "sorted-n-"))]
    # the key is stored: no join gives it
    assert keyed.df.filter("n = 5").inputFiles()


def test_row_count_and_distinct_values(spark):
    from starloom.operators import distinct_values, row_count

    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "s string, n int")
    assert tuple(row_count(df, name="t").first()) == ("t", 3)
    assert sorted(r.s for r in distinct_values(df, "s").collect()) == ["a", "b"]


def test_measured_bytes_in_the_counting_pass_match_a_separate_measure(spark):
    df = spark.createDataFrame([("alpha",), ("be",), ("gamma delta",)], "name string")
    measured = assign_dense_key(df, ["name"], "id", measure_bytes=True)
    later = assign_dense_key(df, ["name"], "id")
    assert measured.data_bytes == later.data_bytes > 0
