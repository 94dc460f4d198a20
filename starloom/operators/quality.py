"""Data-quality reports (AGG4, AGG5, DQ1-DQ3).

The null census is one global aggregate: every task counts its own nulls and
only one partial row per task is shuffled, whatever the table size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def null_census(df: DataFrame) -> DataFrame:
    """DQ1: one row, one column per input column, holding its null count."""
    return df.select(
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]
    )


def null_census_tall(df: DataFrame) -> DataFrame:
    """DQ1 as rows (column_name, null_count), via unpivot of the wide census."""
    wide = null_census(df)
    return wide.unpivot([], [F.col(f"`{c}`") for c in wide.columns], "column_name", "null_count")


def schema_report(df: DataFrame, expected: T.StructType | None = None) -> DataFrame:
    """DQ2: per column its position, name, type and null count; with ``expected``
    also the expected type and whether it matches.

    The schema rows are metadata of ``df`` (one per column); the null counts
    are computed over all rows of ``df``.
    """
    spark = df.sparkSession
    exp = {f.name: f.dataType.simpleString() for f in (expected.fields if expected else [])}
    rows = [
        (i, f.name, f.dataType.simpleString(), exp.get(f.name))
        for i, f in enumerate(df.schema.fields)
    ]
    meta = spark.createDataFrame(
        rows, "position int, column_name string, data_type string, expected_type string"
    )
    census = null_census_tall(df)
    out = meta.join(F.broadcast(census), "column_name", "left").select(
        "position", "column_name", "data_type", "expected_type",
        (F.col("expected_type").isNull() | (F.col("expected_type") == F.col("data_type"))).alias("type_ok"),
        F.col("null_count").cast("bigint").alias("null_count"),
    )
    return out


def referential_counts(df: DataFrame, parents: dict) -> DataFrame:
    """DQ3 both ways: one row with the rows whose every checked column has a
    parent (``valid_rows``) and the rest (``rejected_rows``).

    ``parents`` maps a column of ``df`` to its parent: a ``Keyed`` table (its
    key set is a dense range, so the check is a predicate) or a DataFrame of
    parent keys under the same column name (checked by a left join to the
    distinct keys, which never multiplies rows).
    """
    from .keys import Keyed

    ok = F.lit(True)
    out = df
    for i, (col, parent) in enumerate(parents.items()):
        if isinstance(parent, Keyed) and parent.key == col:
            ok = ok & F.coalesce(parent.key_in_range(F.col(col)), F.lit(False))
        else:
            keys = parent.select(F.col(col)).distinct().withColumn(f"__has{i}", F.lit(True))
            out = out.join(keys, col, "left")
            ok = ok & F.col(f"__has{i}").isNotNull()
    return out.agg(F.count_if(ok).alias("valid_rows"), F.count_if(~ok).alias("rejected_rows"))


def row_count(df: DataFrame, **labels: str) -> DataFrame:
    """AGG5/AGG9 as a one-row frame (lazy, unlike ``df.count()``), after the
    given label columns."""
    return df.agg(*[F.lit(v).alias(k) for k, v in labels.items()], F.count(F.lit(1)).alias("row_count"))
