"""Cut lineage by writing a table once into the shared checkpoint folder.

A frame that several jobs read (e.g. cleaned records feeding five keyed
tables, each sorted after a sampling pass) would otherwise be recomputed from
the source by every job.  Written as parquet it is computed once, survives the
loss of any executor, and every reader scans only the columns it needs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import remove_path, scratch_path


@dataclass
class Written:
    """A written frame, the folder it lies in, and its metrics if any were asked for."""

    df: DataFrame
    path: str
    metrics: dict

    def remove(self) -> None:
        """Delete the table; ``df`` cannot be read afterwards."""
        remove_path(self.df.sparkSession, self.path)


def observed_write(df: DataFrame, write, **aggregates: Column) -> dict:
    """Run ``write(df)`` and return the aggregates over the rows it wrote,
    gathered in the write pass itself: no second scan, no further job."""
    if not aggregates:
        write(df)
        return {}
    seen = Observation()
    write(df.observe(seen, *[c.alias(name) for name, c in aggregates.items()]))
    return seen.get


def materialize(df: DataFrame, name: str = "table", **aggregates: Column) -> Written:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    metrics = observed_write(df, lambda rows: rows.write.parquet(path), **aggregates)
    return Written(spark.read.schema(df.schema).parquet(path), path, metrics)


def row_count_metric() -> Column:
    return F.count(F.lit(1))
