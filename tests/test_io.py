"""CSV sinks and sources (SNK1-3, SRC3-4)."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.sources import read_csv, read_csv_skip_long_lines, write_csv


def _tmp():
    return tempfile.mkdtemp(prefix="starloom-io-")


def test_exact_roundtrip_keeps_values(spark):
    rows = [(1, " Crime", 'a "q", b'), (2, "Crime ", "line1\nline2"), (3, None, ""), (4, "x", "plain")]
    schema = "id int, g string, t string"
    df = spark.createDataFrame(rows, schema)
    path = os.path.join(_tmp(), "out")
    write_csv(df, path, quoting="exact", single_file=True)
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 1
    back = sorted(map(tuple, read_csv(spark, path, schema).collect()))
    # every value survives except '' which comes back as null
    assert back == [(1, " Crime", 'a "q", b'), (2, "Crime ", "line1\nline2"), (3, None, None), (4, "x", "plain")]


def test_spark_default_quoting_trims(spark):
    df = spark.createDataFrame([(1, " Crime"), (2, "Crime ")], "id int, g string")
    path = os.path.join(_tmp(), "out")
    write_csv(df, path, quoting="spark")
    back = sorted(map(tuple, read_csv(spark, path, "id int, g string", quoting="spark").collect()))
    assert back == [(1, "Crime"), (2, "Crime")]


def test_skip_only_too_long_lines(spark):
    d = _tmp()
    with open(os.path.join(d, "t.csv"), "w") as f:
        f.write('id,name,val\n1,a,10\n2,b\n3,c,30,extra\n4,d,xx\n5,e,50,\n6,f,60,,\n7,"g,h",70\n8,"i,j"\n')
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
                           T.StructField("val", T.IntegerType())])
    df = read_csv_skip_long_lines(spark, d, schema)
    assert sorted(map(tuple, df.collect())) == [(1, "a", 10), (2, "b", None), (4, "d", None), (7, "g,h", 70),
                                                 (8, "i,j", None)]
    # the same rows when a projection prunes the scan
    assert df.select("id").count() == 5


def test_export_star_writes_seven_tables(spark):
    from starloom.catalog import spark_queries as sq
    from starloom.plans.export import export_star

    star = sq.star(spark, "/root/testdata/sf0.001")
    out = os.path.join(_tmp(), "star")
    paths = export_star(star, out, single_file=True)
    assert sorted(paths) == ["authors", "book_genres", "book_ratings", "books", "genres", "ratings", "reviews"]
    authors = read_csv(spark, paths["authors"], "author_id long, author_name string")
    assert sorted(map(tuple, authors.collect())) == sorted(map(tuple, star.authors.df.collect()))
    books = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(paths["books"])
    assert books.columns == ["book_id", "book_title", "author_id", "num_pages", "cover_type", "publish_date",
                             "description", "genre_ids"]
    assert books.count() == star.books.rows


def test_scan_any_format_feeds_cleaning(spark):
    from starloom.plans import clean_records
    from starloom.sources import raw_records_from_part, read_table

    raw = raw_records_from_part(spark.read.parquet("/root/testdata/sf0.001/part.parquet"))
    path = os.path.join(_tmp(), "raw_json")
    raw.write.json(path)
    back = read_table(spark, path, fmt="json")
    a = clean_records(back, as_of=None).drop("date_text", "cleaned_date")
    b = clean_records(raw, as_of=None).drop("date_text", "cleaned_date")
    assert a.count() == b.count()
    assert a.select(*b.columns).exceptAll(b).count() == 0


def test_skip_long_lines_spark_quoting(spark):
    d = _tmp()
    with open(os.path.join(d, "t.csv"), "w") as f:
        f.write('id,name,val\n1,"a \\"x\\", b",10\n2,"c,d",20,extra\n3,e\n5,"j \\",k,l,m"\n')
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
                           T.StructField("val", T.IntegerType())])
    df = read_csv_skip_long_lines(spark, d, schema, quoting="spark")
    assert sorted(map(tuple, df.collect())) == [(1, 'a "x", b', 10), (3, "e", None), (5, 'j ",k,l,m', None)]


def test_cli_end_to_end(spark, capsys):
    from starloom.__main__ import main

    out = os.path.join(_tmp(), "cli")
    main(["--part", "/root/testdata/sf0.001/part.parquet", "--out", out, "--as-of", "2025-01-15",
          "--single-file", "--top", "1"])
    printed = capsys.readouterr().out
    assert "== books per genre" in printed
    for name in ("authors", "books", "ratings", "genres", "reviews", "book_genres", "book_ratings"):
        parts = [f for f in os.listdir(os.path.join(out, name)) if f.startswith("part-")]
        assert len(parts) == 1


def test_unclosed_quote_costs_one_record(spark):
    d = _tmp()
    with open(os.path.join(d, "t.csv"), "w") as f:
        f.write('id,name\n1,a\n2,"b\n3,c\n4,d\n')
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
    got = sorted(map(tuple, read_csv_skip_long_lines(spark, d, schema).collect()))
    assert [r for r in got if r[0] != 2] == [(1, "a"), (3, "c"), (4, "d")]


def test_line_oriented_files_are_split(spark):
    d = _tmp()
    with open(os.path.join(d, "t.csv"), "w") as f:
        f.write("id,name\n" + "".join(f"{i},name{i}\n" for i in range(60_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        assert read_csv(spark, d, "id int, name string", multi_line=False).rdd.getNumPartitions() > 4
        assert read_csv(spark, d, "id int, name string").rdd.getNumPartitions() == 1
        assert read_csv(spark, d, "id int, name string", multi_line=False).count() == 60_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_second_export_replaces_the_first(spark):
    path = os.path.join(_tmp(), "out")
    write_csv(spark.range(100), path)
    write_csv(spark.range(7), path, single_file=True)
    assert read_csv(spark, path, "id long").count() == 7
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 1


def test_single_file_of_what_all_tasks_write(spark, tmp_path):
    """Rows too many for one task: all write, and the bytes are joined, in the rows' order."""
    import gzip

    rows = spark.range(0, 1000, 1, 5).select("id", F.when(F.col("id") % 7 != 0, F.col("id") * 3).alias("n"), F.spark_partition_id().alias("task"))
    want = sorted(tuple(r) for r in rows.collect())
    path = str(tmp_path / "one")
    for compression, opened in (("gzip", gzip.open), (None, open)):
        write_csv(rows, path, single_file=True, staged=False, compression=compression)
        (file,) = [p for p in (tmp_path / "one").iterdir() if p.name.startswith("part-")]
        with opened(file, "rt") as text:
            lines = text.read().splitlines()
        assert lines[0] == "id,n,task" and [int(x.split(",")[0]) for x in lines[1:]] == list(range(1000))
        for multi_line in (True, False):
            back = read_csv(spark, path, "id long, n long, task int", multi_line=multi_line)
            assert sorted(tuple(r) for r in back.collect()) == want and len({r["task"] for r in back.collect()}) == 5


def test_joined_file_keeps_the_modes(spark, tmp_path):
    path = str(tmp_path / "one")
    count = lambda: (read_csv(spark, path, "id long").count(), sum(p.name.startswith("part-") for p in (tmp_path / "one").iterdir()))
    write = lambda n, mode: write_csv(spark.range(n), path, mode=mode, single_file=True, staged=False, compression="gzip")
    write(10, "error")
    with pytest.raises(FileExistsError):
        write(3, "error")
    write(3, "ignore")
    assert count() == (10, 1)
    write(3, "append")
    assert count() == (13, 2)
    write(0, "overwrite")
    assert count() == (0, 1)  # the header


def test_published_numbers_are_read_by_lines(spark, tmp_path):
    from starloom.operators import Publication
    from starloom.plans.export import read_published

    numbers, texts = spark.range(5), spark.createDataFrame([("a\nb",)], "t string")
    Publication(spark, str(tmp_path)).publish({"n": numbers, "t": texts}, lambda df, p: write_csv(df, p, single_file=True, staged=False, compression="gzip"))
    back = read_published(spark, str(tmp_path), {"n": numbers.schema, "t": texts.schema})
    options = {k: df._jdf.queryExecution().analyzed().relation().options().get("multiLine").get() for k, df in back.items()}
    assert options == {"n": "false", "t": "true"}
    assert back["n"].count() == 5 and {r["t"] for r in back["t"].collect()} == {"a\nb"}
