"""Table scans (SRC1): any Spark data source by format name and options."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str | None = None, fmt: str = "parquet",
               options: dict[str, str] | None = None, schema: T.StructType | str | None = None) -> DataFrame:
    """SRC1: scan a collection as a table.

    ``fmt`` is any installed source: parquet, json, orc, csv, or a connector
    such as a document store when its package is on the classpath (the
    reference scans one; its URI and database go in ``options``).  Filters and
    projections applied later are pushed into the scan by Catalyst.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def read_testdata(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the generated parquet tables, e.g. ``read_testdata(s, d, 'part')``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
