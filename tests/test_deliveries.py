"""Key registry, duplicates by id, bitmap membership, factorised title joins, publishing."""

import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import KeyBitmap, KeyRegistry, Publication, drop_duplicates_by_id, joins
from starloom.operators import assign_dense_key, dedupe, key_registry, renumber
from starloom.plans import load as ld
from starloom.plans import reports, title_blocks
from starloom.plans.clean import clean_records
from starloom.plans.export import publish_star, read_published, star_tables
from starloom.plans.star import Star, title_pairs
from starloom.plans.title_blocks import TitleBlocks
from starloom.session import scratch_path
from starloom.sources import raw_records_from_part, read_testdata

from conftest import SF001


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def raw(spark):
    return raw_records_from_part(read_testdata(spark, SF001, "part"))


# duplicates by id

@pytest.mark.parametrize("id_set", [2000, 2], ids=["set", "join"])
@pytest.mark.parametrize("store", [True, False])
def test_duplicates_by_id_are_those_of_whole_rows(spark, monkeypatch, id_set, store):
    monkeypatch.setattr(dedupe, "ID_SET", id_set)
    rows = [(i % 40, f"t{i % 3}", None if i % 5 else i % 2) for i in range(200)] + [(None, "x", 1), (None, "x", 1), (None, "y", 1), (1000, "once", None)]
    df = spark.createDataFrame(rows, "id long, a string, b int").repartition(3)
    held = []
    assert rows_of(drop_duplicates_by_id(df, "id", store=store, held=held)) == rows_of(df.dropDuplicates())
    assert (len(held) > 0) == (store or id_set == 2)
    for table in held:
        table.remove()


def test_nothing_is_written_where_ids_are_unique(spark):
    held, df = [], spark.range(50).withColumn("a", F.lit("x"))
    assert drop_duplicates_by_id(df, "id", held=held) is df and not held
    assert drop_duplicates_by_id(df.limit(0), "id").count() == 0


def test_reports_read_and_shuffle_their_own_columns(spark):
    cleaned = clean_records(raw(spark))
    plan = reports.author_counts(cleaned)._jdf.queryExecution().executedPlan().toString()
    assert "Description" not in plan and "Genres" not in plan
    exchanged = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanged and all("author" in line and "title" not in line for line in exchanged)


def test_all_ways_of_exact_duplicates_agree(spark):
    want = rows_of(clean_records(raw(spark), dedupe="lazy"))
    assert rows_of(clean_records(raw(spark))) == want
    assert rows_of(clean_records(raw(spark), store_repeated=False)) == want
    with pytest.raises(ValueError):
        clean_records(raw(spark), dedupe="other")


# key registry

def registry(spark, columns="name string, place long"):
    return KeyRegistry(spark, scratch_path(spark, "registry"), columns, "id")


def test_registry_keeps_ids_and_extends(spark):
    reg = registry(spark)
    first = spark.createDataFrame([("b", 1), ("a", None), (None, 1), ("b", 1)], "name string, place long")
    made = reg.extend(first, "monday")
    assert (made.first, made.rows) == (0, 3)
    before = {(r["name"], r["place"]): r["id"] for r in reg.keys().collect()}
    assert before == {(None, 1): 0, ("a", None): 1, ("b", 1): 2}
    made = reg.extend(first.unionByName(spark.createDataFrame([("0", 9), (None, None)], "name string, place long")), "tuesday")
    assert (made.first, made.rows) == (3, 2)
    after = {(r["name"], r["place"]): r["id"] for r in reg.keys().collect()}
    assert {k: after[k] for k in before} == before and after[None, None] == 3 and after["0", 9] == 4
    assert {(r["name"], r["place"]): r["id"] for r in reg.keys("monday").collect()} == before
    # a delivery that is known adds nothing, whatever it brings
    assert reg.extend(spark.createDataFrame([("new", 1)], "name string, place long"), "tuesday") == made
    assert len(reg.keys().collect()) == 5
    got = reg.attach(spark.createDataFrame([("b", 1, "x"), ("b", 1, "y"), ("?", 0, "z")], "n string, p long, v string"), {"name": "n", "place": "p"}, "left")
    assert {(r["v"], r["id"]) for r in got.collect()} == {("x", 2), ("y", 2), ("z", None)}
    assert reg.extend(first.limit(0), "empty").rows == 0 and reg.keys().count() == 5


def test_delivery_that_dies_before_its_ledger_is_not_seen(spark, monkeypatch):
    reg = registry(spark, "name string")
    reg.extend(spark.createDataFrame([("a",)], "name string"), "one")

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(key_registry, "rename_new", dies)
        with pytest.raises(RuntimeError):
            reg.extend(spark.createDataFrame([("x",), ("y",)], "name string"), "two")
    assert [d.name for d in reg.deliveries()] == ["one"] and reg.keys().count() == 1
    made = reg.extend(spark.createDataFrame([("b",)], "name string"), "two")
    assert (made.first, made.rows) == (1, 1) and rows_of(reg.keys()) == [(0, "a"), (1, "b")]


def test_two_writers_cannot_both_commit(spark):
    reg = registry(spark, "name string")
    other = KeyRegistry(spark, reg.path, "name string", "id")
    other.deliveries = lambda: []  # read before the other committed
    reg.extend(spark.createDataFrame([("a",)], "name string"), "one")
    with pytest.raises(FileExistsError):
        other.extend(spark.createDataFrame([("b",)], "name string"), "two")


def test_star_ids_survive_a_second_delivery(spark):
    path = scratch_path(spark, "registries")
    whole = clean_records(raw(spark), keep_id=True)
    part = clean_records(raw(spark).filter(F.col("Rank").cast("long") % 5 != 0), keep_id=True)
    one, two = Star(part, registry=path, delivery="1"), Star(whole, registry=path, delivery="2")
    for table, key in (("books", "record_id"), ("ratings", "record_id"), ("genres", "genre_name"), ("authors", "author_name")):
        a, b = ({r[key]: r[0] for r in getattr(s, table).df.collect()} for s in (one, two))
        assert a and {k: b[k] for k in a} == a and len(set(b.values())) == len(b)
        assert max(a.values()) < min([v for k, v in b.items() if k not in a] or [10**9])
    # the views and bridges of a star with a registry use its ids
    ids = {r["book_id"] for r in two.books.df.collect()}
    assert {r["book_id"] for r in two.book_genres.collect()} <= ids
    assert {r["book_id"] for r in two.reviews.df.collect()} == ids
    assert two.reviews.df.count() == Star(whole).reviews.df.count()
    loaded = ld.drop_existing(two.books.df, one.books, "book_id")  # no range predicate on ids that are no range
    assert loaded.count() == two.books.rows - one.books.rows
    with pytest.raises(ValueError):
        two.books.key_in_range("book_id")
    with pytest.raises(ValueError):
        Star(clean_records(raw(spark)), registry=path)
    two.close()


ODD = "title string, record_id string, reviews int, score int"


def odd_deliveries(spark):
    """Rows come, go, come back, change their title, repeat their id or have none."""
    rng = random.Random(3)
    rows = [("hot" if i % 3 else f"t{i % 5}", f"id{i:03d}", i % 7 or None, i) for i in range(60)]
    two = [r for r in rows if rng.random() < .7]
    two = [("t1" if i % 9 == 0 else t, x, n, i) for i, (t, x, n, _) in enumerate(two)] + [("hot", f"A{i}", i, i) for i in range(9)]
    three = [r for r in rows + two if rng.random() < .6] + [("hot", None, 1, 1), ("hot", None, 2, 2), ("t2", None, 1, 3), (None, "id001", 1, 4), ("new", "id001", 1, 5)]
    four = [(f"m{i % 2}", x, n, s) for i, (_, x, n, s) in enumerate(rows)] + [("new", "id001", 1, 7), ("alone", "z", None, None)]
    return [spark.createDataFrame(d, ODD) for d in (rows[:40], two, three, [], four)]


def test_review_ids_from_two_sides_are_those_of_kept_pairs(spark, monkeypatch):
    """Over odd deliveries, and one given twice with other rows: the ids that a registry
    of all pairs gives; pairs are neither kept nor shuffled."""
    import starloom.plans.star as st
    import starloom.plans.title_blocks as tb

    monkeypatch.setattr(tb, "REVIEW_BLOCK", 8)
    path, deliveries = scratch_path(spark, "registries"), odd_deliveries(spark)
    for n, rows in [*enumerate(deliveries), (1, deliveries[2])]:
        rows = rows.localCheckpoint()
        books = st.registered(rows.withColumnRenamed("title", "book_title"), "books", path, str(n))
        want = st.registered(st.review_rows(rows, books).select("book_id", "reviews", "score", "record_id"), "reviews", path, str(n))
        titles = st.review_registry(books, path)
        titles.extend(books.df, str(n))
        got = tb.registered_reviews(rows, books, titles)
        assert got.df.columns == want.df.columns and rows_of(got.df) == rows_of(want.df) and got.rows == want.rows
        plan = got.df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan
        sides = sum(spark.read.parquet(f"{titles.path}/gen-{d.generation:06d}").count() for d in titles.deliveries())
        assert sides <= sum(d.count() for d in deliveries)
    kept = KeyRegistry(spark, f"{path}/reviews", "book_id long, record_id string", "review_id").deliveries()
    assert [(d.name, d.first, d.rows) for d in titles.deliveries()] == [(d.name, d.first, d.rows) for d in kept]


def test_star_goes_on_with_a_registry_of_pairs(spark):
    cleaned = clean_records(raw(spark), keep_id=True)
    path = scratch_path(spark, "registries")
    by_record = {r["record_id"]: r["review_id"] for r in Star(cleaned, registry=path, delivery="1", attach="record").reviews.df.collect()}
    two = Star(cleaned, registry=path, delivery="2")
    own = {r["record_id"]: r["review_id"] for r in two.reviews.df.join(two.books.df.select("book_id", "record_id"), ["book_id", "record_id"]).collect()}
    assert by_record and own == by_record
    other = scratch_path(spark, "registries")
    assert Star(cleaned, registry=other).reviews.rows == two.reviews.rows
    with pytest.raises(ValueError):
        Star(cleaned, registry=other, delivery="2", attach="record").reviews


def test_increment_gives_only_what_is_new(spark):
    reg = registry(spark, "name string")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "name string, v int")
    assert rows_of(ld.increment(rows, reg, "1")) == [(0, "a", 1), (1, "b", 2)]
    more = rows.unionByName(spark.createDataFrame([("A", 3)], "name string, v int"))
    for _ in range(2):
        assert rows_of(ld.increment(more, reg, "2")) == [(2, "A", 3)]


# bitmap membership

def test_bitmap_membership_is_exact(spark):
    rng = random.Random(1)
    keys = [rng.randint(-200_000, 200_000) for _ in range(3000)] + [0, -1, 1, 32768, 32767, -32768, 2**62, -2**62, 2**63 - 1, -2**63, None]
    child = [rng.randint(-200_000, 200_000) for _ in range(3000)] + keys[:500] + keys[-11:] + [2, -2]
    have = {k for k in keys if k is not None}
    bitmap = KeyBitmap.of(spark.createDataFrame([(k,) for k in keys], "k long").repartition(5), "k")
    df = spark.createDataFrame([(i, c) for i, c in enumerate(child)], "i long, c long")
    assert bitmap.count() == len(have)
    assert {r["i"] for r in bitmap.keep(df, "c").collect()} == {i for i, c in enumerate(child) if c in have}
    assert {r["i"] for r in bitmap.drop(df, "c").collect()} == {i for i, c in enumerate(child) if c not in have}
    none = KeyBitmap.of(spark.createDataFrame([(None,)], "k int"), "k")
    assert none.buckets == 0 and none.keep(df, "c").count() == 0 and none.drop(df, "c").count() == len(child)


def test_a_row_looks_at_a_bit_without_text(spark):
    """Bytes become words once per bucket, every bit of which is found."""
    from starloom.operators import bitmap_membership as bm

    assert "conv(" not in str(bm._bit(F.col("w"), F.col("p")))
    keys = [k for k in range(-70_000, 70_000) if k * k % 11 in (1, 3)]
    bitmap = KeyBitmap.of(spark.createDataFrame([(k,) for k in keys], "k long"), "k")
    kept = bitmap.keep(spark.range(-70_000, 70_000), "id")
    assert sorted(r["id"] for r in kept.collect()) == keys


def test_bitmaps_of_deliveries_join(spark):
    a, b = (KeyBitmap.of(spark.range(x, y), "id") for x, y in ((0, 40_000), (30_000, 70_000)))
    both = KeyBitmap.union(a, b)
    assert both.count() == 70_000 and both.buckets == 4  # key 0 has a bucket of its own
    assert both.drop(spark.range(69_990, 70_010), "id").count() == 10


def test_bitmap_shuffles_buckets_not_parent_rows(spark):
    plan = spark.range(100_000).groupBy(F.bitmap_bucket_number("id").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in text and text.count("Exchange") == 1


# factorised title joins

def titles(spark):
    left = [(i, None if i % 9 == 8 else f"t{i % 4}" if i % 3 else "hot", i % 5 or None) for i in range(120)]
    right = [(i, None if i % 7 == 6 else f"t{i % 6}" if i % 2 else "hot", float(i)) for i in range(150)]
    return spark.createDataFrame(left, "a long, t string, x int"), spark.createDataFrame(right, "b long, t string, y double")


@pytest.mark.parametrize("block", [4, 512])
def test_expanded_blocks_are_the_join(spark, monkeypatch, block):
    monkeypatch.setattr(title_blocks, "BLOCK", block)
    monkeypatch.setattr(title_blocks, "PAIRS_PER_TASK", 64)
    left, right = titles(spark)
    found = TitleBlocks(left, right, "t", "a", "b")
    want = rows_of(left.join(right, "t").select("a", "b"))
    assert rows_of(found.expanded()) == want
    a, b = found.blocks()
    assert max(len(r[1]) for r in [*a.collect(), *b.collect()]) <= (block * 4 if block == 4 else block)
    assert found.pair_count().first()["valid_rows"] == len(want)


def test_pair_sums_are_those_of_the_pairs(spark):
    left, right = titles(spark)
    found = TitleBlocks(left, right, "t", "a", "b").pair_sums({"sx": "x"}, {"sy": "y"})
    assert rows_of(found) == rows_of(left.join(right, "t").groupBy("t").agg(
        F.count(F.lit(1)).alias("pairs"), F.sum("x").alias("sx"), F.sum("y").alias("sy")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and plan.count("Join") == 1  # of per-title rows


def test_expanded_bridge_is_the_bridge(spark):
    s = Star(clean_records(raw(spark)))
    s.build("books", "ratings")
    assert rows_of(TitleBlocks.of(s.books, s.ratings).expanded()) == rows_of(title_pairs(s.books, s.ratings))
    assert joins.PAIRS_PER_TASK > 0


def test_reviews_are_numbered_from_their_two_sides(spark, monkeypatch):
    """By title, with ties, a hot title and blocks smaller than it: the ids of a sort of
    all pairs, no pair shuffled, and the same rows with the books' columns."""
    import starloom.plans.title_blocks as tb

    monkeypatch.setattr(tb, "REVIEW_BLOCK", 8)
    monkeypatch.setattr(tb, "PAIRS_PER_TASK", 200)
    rows = [("hot" if i % 3 else f"t{i % 40}", i % 7 if i % 11 else None, i % 5) for i in range(150)] + [(None, 1, 1)]
    recs = spark.createDataFrame(rows, "title string, reviews int, score int")
    books = assign_dense_key(recs.select(F.col("title").alias("book_title"), F.col("score").alias("num_pages")), ["book_title", "num_pages"], "book_id")
    found = tb.ReviewBlocks.of(recs, books, ["reviews", "score"])
    low = lambda v: (v is not None, v)
    pairs = sorted(((b, r[1], r[2]) for b, t in books.df.select("book_id", "book_title").collect() for r in rows if t is not None and r[0] == t),
                   key=lambda p: tuple(low(v) for v in p))
    out = found.expanded()
    assert sorted(map(tuple, out.collect())) == sorted(((i, *p) for i, p in enumerate(pairs)), key=lambda p: p[0])
    assert found.rows == len(pairs) and "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert rows_of(found.with_books(books.df)) == rows_of(books.df.join(out, "book_id"))


def test_renumbered_bridge_sorts_no_pair(spark):
    rows = [(b, r) for b in (None, 3, 5, 9) for r in range(0, 9000 if b == 5 else 4)] + [(3, 1)]
    pairs = spark.createDataFrame(rows, "book_id long, rating_id long")
    found = ld._renumbered(pairs)
    assert rows_of(found) == rows_of(renumber(pairs.withColumnRenamed("rating_id", "o"), ["book_id", "o"], "rating_id").df.drop("o"))
    keys = spark.createDataFrame([(k,) for k in (1, 2, 7, 9000, -4)], "rating_id int")
    out = ld.prepare_book_ratings(pairs, keys, spark.range(3, 6).withColumnRenamed("id", "book_id"))
    assert out.columns == ["book_id", "rating_id"] and rows_of(out) == [(3, 7), (5, 9000)]
    assert "hashpartitioning(rating_id" not in out._jdf.queryExecution().executedPlan().toString()


def test_single_file_is_copied_by_its_one_task(spark, monkeypatch):
    """Sorts and joins run before, in all tasks: what one task writes is a scan."""
    import starloom.sources.csv_io as cs

    seen, real = [], cs.materialize
    monkeypatch.setattr(cs, "materialize", lambda df, name: seen.append(real(df, name)) or seen[-1])
    path = scratch_path(spark, "one")
    cs.write_csv(spark.range(50).groupBy("id").count(), path, single_file=True, compression="gzip")
    assert "Exchange" not in seen[0].df._jdf.queryExecution().executedPlan().toString()
    assert cs.read_csv(spark, path, "id long, count long").count() == 50


def test_gzip_exports_are_written_at_the_fast_level(spark, monkeypatch):
    """Most of the time of an export of pairs went into the last few bytes of a file."""
    import starloom.sources.csv_io as cs

    pairs = spark.range(0, 200_000, 1, 1).select("id", (F.col("id") * 31 % 1000003).alias("n"), (F.col("id") * 1009 % 9999991).alias("m"))
    held = []
    for level in (cs.GZIP_LEVEL, {}):
        monkeypatch.setattr(cs, "GZIP_LEVEL", level)
        path = scratch_path(spark, "level")
        cs.write_csv(pairs, path, compression="gzip")
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        held.append(p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength())
        assert cs.read_csv(spark, path, "id long, n long, m long").count() == 200_000
    assert held[1] < held[0] < 1.3 * held[1]


# publishing

def test_interrupted_export_leaves_the_old_tables(spark, monkeypatch):
    import starloom.plans.export as ex

    s = Star(clean_records(raw(spark)))
    out = scratch_path(spark, "published")
    publish_star(s, out)
    schemas = {name: df.schema for name, df in star_tables(s).items()}
    before = {name: rows_of(df) for name, df in read_published(spark, out, schemas).items()}
    paths, written, real = Publication(spark, out).current(), [], ex.write_csv

    def dies(df, path, **options):
        if len(written) == 2:
            raise RuntimeError("executor lost")
        written.append(path)
        real(df.limit(1), path, **options)

    with monkeypatch.context() as m:
        m.setattr(ex, "write_csv", dies)
        with pytest.raises(RuntimeError):
            publish_star(s, out)
    assert len(written) == 2 and Publication(spark, out).current() == paths
    assert {name: rows_of(df) for name, df in read_published(spark, out, schemas).items()} == before and len(before) == 7
    publish_star(s, out)
    assert Publication(spark, out).current() != paths
    Publication(spark, out).clean()
    assert len(Publication(spark, out).manifests()) == 1
    assert {name: rows_of(df) for name, df in read_published(spark, out, schemas).items()} == before


def test_census_is_taken_while_writing(spark):
    """No job but the writes: as many jobs with the census as without."""
    s = Star(clean_records(raw(spark)))
    star_tables(s)
    jobs = []
    for census in (None, {}, None, {}):
        group = f"census-{len(jobs)}"
        spark.sparkContext.setJobGroup(group, group)
        publish_star(s, scratch_path(spark, "census"), census=census)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    spark.sparkContext.setJobGroup("", "")
    assert jobs[2] == jobs[3] > 0
    assert census["authors"]["rows"] == s.authors.rows and census["books"]["rows"] == s.books.rows
    assert census["books"]["nulls_publish_date"] == s.books.df.filter("publish_date is null").count()


def test_nothing_published(spark):
    assert Publication(spark, scratch_path(spark, "nothing")).current() == {}
