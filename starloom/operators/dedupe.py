"""Duplicate removal (AGG6, AGG7, AGG8).

Both forms are hash aggregations with a map-side partial step, so a key that
holds a third of all rows is folded inside every map task before the shuffle:
no task ever receives the hot group's rows, only one partial row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import maybe_broadcast
from .materialize import Written, materialize


def drop_exact_duplicates(df: DataFrame, ignore: list[str] | tuple[str, ...] = (),
                          keep_ignored: bool = False) -> DataFrame:
    """AGG7: drop rows equal on every column except ``ignore``.

    With ``keep_ignored`` the ignored columns survive and carry their least
    value within each group, so the result is deterministic.
    """
    if not ignore:
        return df.dropDuplicates()
    rest = [c for c in df.columns if c not in ignore]
    if not keep_ignored:
        return df.select(*[F.col(f"`{c}`") for c in rest]).dropDuplicates()
    aggs = [F.min(F.col(f"`{c}`")).alias(c) for c in ignore]
    return df.groupBy(*[F.col(f"`{c}`") for c in rest]).agg(*aggs).select(*df.columns)


#: Repeated ids that are looked up as a set in the plan; more are joined.
ID_SET = 2000


def drop_duplicates_by_id(df: DataFrame, id_col: str, ids: DataFrame | None = None, store: bool = True,
                          held: list[Written] | None = None) -> DataFrame:
    """The rows of ``df.dropDuplicates()``, found by id first.

    Equal rows have equal ids, so one narrow aggregation over the id column names
    all ids held more than once (null counts as an id), and only their rows meet in
    full; every other row stays where it is.  The ids are counted when this is called:
    up to ``ID_SET`` of them are told apart by a set in the plan, more are written and
    joined, by a broadcast if their measured size allows.

    With ``store`` the rows of repeated ids are de-duplicated once and written, so that
    a reader of few columns scans these and the id only, and shuffles no more than it
    needs itself.  Without, that is left to each reader: for one that reads all columns
    once anyway.  ``ids`` is where the ids are counted, if that is cheaper to read than
    ``df`` (the source before a projection).  Written tables are added to ``held`` for
    the caller to remove.
    """
    key = F.col(f"`{id_col}`")
    counts = (df if ids is None else ids).groupBy(key.alias("__id")).agg(F.count(F.lit(1)).alias("__n"))
    repeated = counts.filter(F.col("__n") > 1).select("__id")
    few = [r[0] for r in repeated.limit(ID_SET + 1).collect()]  # at most ID_SET + 1 values
    if not few:
        return df
    tables = []
    if len(few) <= ID_SET:
        named = [v for v in few if v is not None]
        twice = F.coalesce(key.isin(named), F.lit(False)) if named else F.lit(False)
        twice = twice | key.isNull() if len(named) < len(few) else twice
        single, double = df.filter(~twice), df.filter(twice)
    else:
        size = F.sum(F.lit(24) + F.coalesce(F.octet_length(F.col("__id").cast("string")), F.lit(0)))
        found = materialize(repeated, "repeated-ids", size=size)
        tables.append(found)
        there, same = maybe_broadcast(found.df, int(found.metrics["size"])), key.eqNullSafe(F.col("__id"))
        single, double = df.join(there, same, "left_anti"), df.join(there, same, "left_semi")
    once = double.dropDuplicates()
    if store:
        tables.append(materialize(once, "repeated-rows"))
        once = tables[-1].df
    if held is not None:
        held += tables
    return single.unionByName(once)


def dedupe_by_key(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """AGG8: one row per key, the first by ``order`` (asc, nulls first), ties
    broken by the remaining columns.

    Expressed as ``min(struct(order..., rest...))`` per key, which aggregates
    partially on the map side, unlike a ``row_number`` window that sorts each
    key's whole group in one task.
    """
    order = list(order or [])
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(order + rest)])
    first = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.min(packed).alias("__first"))
    names = order + rest
    return first.select(
        *[F.col(f"`{k}`") for k in keys],
        *[F.col(f"__first.f{i}").alias(c) for i, c in enumerate(names)],
    ).select(*[F.col(f"`{c}`") for c in df.columns])


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    """AGG6: distinct rows of a projection."""
    return df.select(*[F.col(f"`{c}`") for c in cols]).distinct()
