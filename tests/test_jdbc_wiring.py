"""JDBC sinks and the load driver, wired against a recording stand-in for the
JDBC reader and writer (no database may be started in this environment)."""

import re

import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter

from starloom.catalog import spark_queries as sq
from starloom.plans.load import load_star
from starloom.sources import append_rows, jdbc_io, read_key_column, refresh_rows

from conftest import SF001

KEYS = {"genres": ["genre_id"], "books": ["book_id"], "ratings": ["rating_id"], "reviews": ["review_id"],
        "book_genres": ["book_id", "genre_id"], "authors": ["author_id"], "book_ratings": ["book_id", "rating_id"]}


def test_sinks_pass_mode_and_properties(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(DataFrameWriter, "jdbc",
                        lambda self, url, table, mode=None, properties=None: calls.append((url, table, mode, properties)))
    monkeypatch.setattr(jdbc_io, "run_statement", lambda spark, url, statement, properties=None: calls.append(statement))
    df = spark.range(3)
    append_rows(df, "jdbc:x", "t", {"user": "u"}, num_partitions=4)
    refresh_rows(df, "jdbc:x", "t", {"user": "u"})
    refresh_rows(df, "jdbc:x", "t", {"user": "u"}, num_partitions=2, clear="delete")
    assert calls[0] == ("jdbc:x", "t", "append", {"user": "u", "numPartitions": "4"})
    assert calls[1] == ("jdbc:x", "t", "overwrite", {"user": "u", "truncate": "true"})
    assert calls[2:] == ["DELETE FROM t", ("jdbc:x", "t", "append", {"user": "u", "numPartitions": "2"})]
    with pytest.raises(ValueError):
        refresh_rows(df, "jdbc:x", "t", clear="drop")


def test_key_reads_are_partitioned(spark, monkeypatch):
    asked = []

    def read(self, url, table, column=None, lowerBound=None, upperBound=None, numPartitions=None, properties=None):
        asked.append((table, column, lowerBound, upperBound, numPartitions))
        if table.startswith("(SELECT MIN"):
            return spark.createDataFrame([(3, 90)], "lo long, hi long")
        return spark.range(3, 91).toDF("k")

    monkeypatch.setattr(DataFrameReader, "jdbc", read)
    assert read_key_column(spark, "jdbc:x", "t", "k", connections=6).count() == 88
    assert asked[1] == ("t", "k", 3, 91, 6)


class Database:
    """Tables in memory; starts empty unless told otherwise."""

    def __init__(self, spark, star):
        self.spark, self.rows, self.modes = spark, {}, {}
        self.schema = {t: [(c, "bigint") for c in cols] for t, cols in KEYS.items()}

    def write(self, writer, url, table, mode=None, properties=None):
        df = writer._df
        keys = [tuple(r) for r in df.select(*KEYS[table]).collect()]
        self.rows[table] = (self.rows.get(table, []) if mode == "append" else []) + keys
        self.modes[table] = (mode, properties)

    def read(self, reader, url, table, column=None, lowerBound=None, upperBound=None, numPartitions=None, properties=None):
        m = re.match(r"\(SELECT MIN\((\w+)\) AS lo, MAX\(\w+\) AS hi FROM (\w+)\)", table)
        if m:
            values = [r[0] for r in self.rows.get(m[2], [])]
            return self.spark.createDataFrame([(min(values, default=None), max(values, default=None))], "lo long, hi long")
        schema = ", ".join(f"{c} long" for c in KEYS[table])
        return self.spark.createDataFrame(self.rows.get(table, []), schema)


def test_load_star_into_an_empty_database_and_again(spark, monkeypatch):
    star = sq.star(spark, SF001)
    db = Database(spark, star)
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, *a, **k: db.write(self, *a, **k))
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, *a, **k: db.read(self, *a, **k))
    modes = load_star(star, "jdbc:x", {"user": "u"}, renumber_book_ratings=False, connections=3)
    assert list(modes) == ["authors", "genres", "books", "ratings", "reviews", "book_genres", "book_ratings"]
    want = {"authors": star.authors.rows, "genres": star.genres.rows, "books": star.books.rows, "ratings": star.ratings.rows,
            "reviews": star.reviews.rows, "book_genres": star.book_genres.count(), "book_ratings": star.book_ratings.count()}
    assert {t: len(r) for t, r in db.rows.items()} == want and all(want.values())
    assert all(len(r) == len(set(r)) for r in db.rows.values())
    assert all(props["numPartitions"] == "3" for _, props in db.modes.values())
    first = {t: sorted(r) for t, r in db.rows.items()}
    load_star(star, "jdbc:x", {"user": "u"}, renumber_book_ratings=False, connections=3)
    assert {t: sorted(r) for t, r in db.rows.items()} == first
