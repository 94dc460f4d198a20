"""Batches appended once, report states, streams de-duplicated over all time, the JDBC batch append."""

import json
import shutil

import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter
from pyspark.sql import functions as F

from starloom.operators import BatchTables, batches
from starloom.plans import reports
from starloom.plans.clean import clean_records
from starloom.plans.report_state import ReportState
from starloom.session import scratch_path
from starloom.sources import append_batch, jdbc_io, raw_records_from_part, read_testdata
from starloom.streaming import clean_stream_once

from conftest import SF001


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def raw(spark):
    return raw_records_from_part(read_testdata(spark, SF001, "part"))


def test_a_batch_counts_once(spark):
    t = BatchTables(spark, scratch_path(spark, "batches"))
    a, b = spark.range(5).toDF("x"), spark.range(5, 8).toDF("x")
    assert t.read("t", "x long").count() == 0 and t.rows("t") == 0
    first = t.append("a", {"t": a, "other": b})
    assert t.append("a", {"t": b}) == first and t.rows("t") == 5
    t.append("b", {"t": b})
    t.append("none", {"t": b.limit(0)})
    assert rows_of(t.read("t", "x long")) == [(i,) for i in range(8)] and t.read("other", "x long").count() == 3
    assert {(r["by"], r["x"]) for r in t.read("t", "x long", "by").collect()} == {("a", i) for i in range(5)} | {("b", i) for i in range(5, 8)}
    t.retract("a")
    assert rows_of(t.read("t", "x long")) == [(5,), (6,), (7,)] and t.rows("t") == 3 and t.rows("other") == 0
    t.append("a", {"t": a})  # once taken back, it may come again
    t.clean()
    assert t.rows("t") == 8 and t.read("t", "x long").count() == 8


def test_a_batch_that_dies_is_not_seen(spark, monkeypatch):
    t = BatchTables(spark, scratch_path(spark, "batches"))
    t.append("a", {"t": spark.range(3)})

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(batches, "rename_new", dies)
        with pytest.raises(RuntimeError):
            t.append("b", {"t": spark.range(100)})
    with pytest.raises(Exception):
        t.append("c", {"t": spark.range(5), "u": spark.range(5).select(F.raise_error(F.lit("task lost")))})
    assert list(t.batches()) == ["a"] and t.read("t", "id long").count() == 3
    t.append("b", {"t": spark.range(2)})
    t.clean()
    assert t.read("t", "id long").count() == 5


def test_counts_come_from_the_write_itself(spark, monkeypatch):
    t = BatchTables(spark, scratch_path(spark, "batches"))
    t.append("a", {"t": spark.range(7)})
    assert t.batches()["a"].tables["t"][1] == 7 and json.dumps(t.batches()["a"].__dict__)


def test_reports_of_deliveries_are_those_of_the_union(spark):
    state = ReportState(spark, scratch_path(spark, "reports"))
    rows, number = raw(spark), F.col("Rank").cast("long")
    for i in (0, 1, 2, 1):
        state.add(f"d{i}", clean_records(rows.filter(number % 3 == i)))
    state.add("wrong", clean_records(rows.limit(20)))
    state.retract("wrong")
    whole = clean_records(rows)
    assert state.author_counts().collect() == reports.author_counts(whole).collect()
    assert state.genre_counts().collect() == reports.genre_counts(whole).collect()
    rounded = lambda df: rows_of(df.withColumn("average_rating", F.round("average_rating", 6)))
    assert rounded(state.title_ratings()) == rounded(reports.title_ratings(whole))
    state.retract("d0")
    assert state.author_counts().collect() == reports.author_counts(clean_records(rows.filter(number % 3 != 0))).collect()


def test_stream_drops_what_any_earlier_batch_brought(spark, tmp_path):
    part = read_testdata(spark, SF001, "part")
    src, out = str(tmp_path / "in"), scratch_path(spark, "once")
    part.filter("p_partkey <= 150").repartition(3).write.parquet(f"{src}")
    tables = clean_stream_once(spark, src, out, "s", max_files=1)
    assert len(tables.batches()) == 3
    part.filter("p_partkey > 120").coalesce(1).write.mode("append").parquet(src)
    # the same stream goes on from its checkpoint; a new one reads everything again
    for name in ("s", "again"):
        tables = clean_stream_once(spark, src, out, name, max_files=2)
    got = tables.read("cleaned", clean_records(raw(spark), dedupe="none").schema)
    assert rows_of(got) == rows_of(clean_records(raw(spark)))
    assert tables.rows("seen") == tables.rows("cleaned") == part.count()
    # a checkpoint that is lost makes the stream number its batches anew: the ledger knows them
    shutil.rmtree(f"{out}/_checkpoint-again".replace("file:", ""))
    assert clean_stream_once(spark, src, out, "again", max_files=2).rows("cleaned") == part.count()


def test_jdbc_batch_is_moved_on_once(spark, monkeypatch):
    """Against a stand-in: a task that inserts twice, a batch that comes twice."""
    staging, done, ran, fail = [], [], [], [True]

    def write(self, url, table, mode=None, properties=None):
        assert (table, mode) == ("t_staging", "append")
        rows = [tuple(r) for r in self._df.collect()]
        staging.extend(rows + rows[:2])  # a task was run again

    def read(self, url, table, properties=None, **_):
        return spark.createDataFrame([("b1",)] if done else [], "batch_id string")

    def statements(spark, url, texts, properties=None):
        ran.append(texts)
        if fail.pop():
            raise RuntimeError("connection lost")
        done.append("b1")

    monkeypatch.setattr(DataFrameWriter, "jdbc", write)
    monkeypatch.setattr(DataFrameReader, "jdbc", read)
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "x long, y string").repartition(2)
    with pytest.raises(RuntimeError):
        append_batch(df, "jdbc:x", "t", "b1", statements=statements)
    fail.append(False)
    assert append_batch(df, "jdbc:x", "t", "b1", statements=statements)
    assert not append_batch(df, "jdbc:x", "t", "b1", statements=statements)
    assert len(ran) == 2 and ran[1][0] == "INSERT INTO append_ledger (batch_id, target) VALUES ('b1', 't')"
    # equal rows have numbers of their own, a repeated task repeats its numbers, and only this attempt's rows move on
    attempts = [{r for r in staging if r[3] == a} for a in dict.fromkeys(r[3] for r in staging)]
    assert [len(a) for a in attempts] == [3, 3] and len({r[4] for r in attempts[1]}) == 3
    moved = f"SELECT DISTINCT batch_row, x, y FROM t_staging WHERE batch_id = 'b1' AND attempt_id = '{next(iter(attempts[1]))[3]}'"
    assert moved in ran[1][1] and ran[1][2] == "DELETE FROM t_staging WHERE batch_id = 'b1'"
    with pytest.raises(ValueError):
        append_batch(df, "jdbc:x", "t", "x'; DROP TABLE t", statements=statements)
    assert jdbc_io.run_statements
