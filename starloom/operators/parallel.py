"""Spread CPU-heavy per-row work over the cluster's cores when the source
arrives in fewer splits than cores (one large file, one row group)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, slots: int) -> DataFrame:
    """``df`` over at least ``slots`` tasks: a source of fewer splits is dealt
    out by one round-robin shuffle, small next to the work it parallelises; any
    other source is read as it is, since moving it would gain nothing.  The rows
    are the same either way."""
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df
