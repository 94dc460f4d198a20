"""CSV read in splits: the rows of a whole reading, however the file is cut."""

import random

import pytest

from starloom.session import scratch_path
from starloom.sources import read_csv, read_csv_split, write_csv

SCHEMA = "k long, a string, b string, c double"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def awkward(spark, n=400):
    rng = random.Random(5)
    bits = ["\n", '"', ",", "x", "é", "\r", " ", '""', "\n\n", "word ", "日本"]
    text = lambda: "".join(rng.choice(bits) for _ in range(rng.randint(1, 12))) or None
    rows = [(i, text() if rng.random() < 0.8 else None, text() if rng.random() < 0.3 else "plain", i / 4) for i in range(n)]
    rows[7] = (7, "\n".join(f'line "{j}"' for j in range(300)), None, None)  # one record over many splits
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("split", [97, 1000, 1 << 20])
def test_splits_give_the_rows_of_a_whole_reading(spark, split):
    path = scratch_path(spark, "split-csv")
    write_csv(awkward(spark).repartition(2), path)
    want = rows_of(read_csv(spark, path, SCHEMA, multi_line=True))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = read_csv_split(spark, path, SCHEMA)
        assert rows_of(found) == want and len(want) == 400
        if split == 97:
            assert found.rdd.getNumPartitions() > 50
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_file_without_records(spark):
    path = scratch_path(spark, "split-csv")
    write_csv(awkward(spark).limit(0).coalesce(1), path)
    assert read_csv_split(spark, path, SCHEMA).count() == 0
