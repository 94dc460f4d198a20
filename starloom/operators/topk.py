"""Sorted reports and top-k (SRT1, SRT2, SNK7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sort_desc(df: DataFrame, by: str, tiebreak: list[str] | None = None) -> DataFrame:
    """SRT1: descending on ``by`` (NaN first, nulls last), ascending tie-break."""
    return df.orderBy(F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in (tiebreak or [])])


def top_k(df: DataFrame, by: str, k: int = 20, tiebreak: list[str] | None = None) -> DataFrame:
    """SRT2: the first ``k`` rows of ``sort_desc``; planned as
    TakeOrderedAndProject (k rows per task, then one merge of k x tasks)."""
    return sort_desc(df, by, tiebreak).limit(k)
