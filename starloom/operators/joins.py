"""Join helpers: broadcast only behind a measured size, else let Spark shuffle.

All joins of the reference are equi-joins (inner, left, semi, anti).  A side
is broadcast only when its real size is known (``Keyed.data_bytes`` is
measured while keys are assigned) and fits the session's broadcast budget;
beyond that the join is left to the planner (sort-merge).  AQE splits skewed
partitions by their bytes; keys whose *output* is large are cut by
``salted_join``, from measured pair counts.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .materialize import materialize

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def _bytes(raw) -> int | None:
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", str(raw))
    if not m:
        return None
    n = int(m.group(1))
    return -1 if n < 0 else n * _UNITS.get(m.group(2).lower(), 1)


def broadcast_budget(spark: SparkSession) -> int:
    """Bytes a measured broadcast side may hold: the runtime (AQE) broadcast
    threshold if set, else the static one; -1 disables broadcasting."""
    for key in ("spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.autoBroadcastJoinThreshold"):
        raw = spark.conf.get(key, None)
        if raw not in (None, ""):
            b = _bytes(raw)
            if b is not None:
                return b
    return 10 << 20


def maybe_broadcast(df: DataFrame, data_bytes: int | None) -> DataFrame:
    """Mark ``df`` for broadcast when its measured size fits the budget."""
    if data_bytes is None:
        return df
    budget = broadcast_budget(df.sparkSession)
    if budget >= 0 and data_bytes <= budget:
        return F.broadcast(df)
    return df


def lookup(fact: DataFrame, dim: DataFrame, left_on: str, right_on: str, how: str = "left",
           dim_bytes: int | None = None) -> DataFrame:
    """Attach dimension columns by an equi-join; the right key is dropped."""
    d = maybe_broadcast(dim, dim_bytes)
    return fact.join(d, fact[left_on] == d[right_on], how).drop(d[right_on])


#: Output pairs of one key that one task makes, about.
PAIRS_PER_TASK = 4_000_000


def hot_pairs(left: DataFrame, right: DataFrame, on: str, max_pairs: int = PAIRS_PER_TASK) -> DataFrame | None:
    """Keys whose join makes more than ``max_pairs`` pairs, with the cuts of
    either side that bring a piece down to that: (on, __cuts_l, __cuts_r);
    None if there is no such key.

    Measured from per-key counts of both sides (partial aggregates over the key
    column), not from bytes: m short rows that meet n short rows are small, their
    m x n pairs are not.  The table has at most total pairs / max_pairs rows; its
    size is measured and it is broadcast only within the budget."""
    m = left.groupBy(on).agg(F.count(F.lit(1)).alias("__m"))
    n = right.groupBy(on).agg(F.count(F.lit(1)).alias("__n"))
    pairs = F.col("__m").cast("double") * F.col("__n")
    cells = F.ceil(pairs / max_pairs)
    cuts_l = F.least(F.col("__m"), F.greatest(F.lit(1), F.ceil(F.sqrt(cells * F.col("__m") / F.col("__n")))))
    hot = m.join(n, on).filter(pairs > max_pairs).withColumn("__cuts_l", cuts_l.cast("int")).withColumn(
        "__cuts_r", F.ceil(cells / F.col("__cuts_l")).cast("int")).select(on, "__cuts_l", "__cuts_r")
    held = materialize(hot, "hot-keys", n=F.count(F.lit(1)),
                       size=F.sum(F.coalesce(F.octet_length(F.col(on).cast("string")), F.lit(0)) + 40))
    if not held.metrics["n"]:
        held.remove()
        return None
    return maybe_broadcast(held.df, int(held.metrics["size"]))


def salted_join(left: DataFrame, right: DataFrame, on: str, how: str = "inner",
                hot: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """Equi-join on ``on`` that cuts the hot keys of :func:`hot_pairs` on both
    sides: a left row is dealt to one of its key's left cuts and copied to every
    right cut, a right row the other way round, so each pair is made once, in
    the cell of its two cuts.  Cuts go by a hash of the whole row, alike when a
    task is repeated.  Inner and left joins.

    ``tasks`` fixes the number of tasks, from the pairs they make: AQE would go by the
    sides' bytes, and few short rows make many pairs."""
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")

    def met(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
        if tasks:
            a, b = a.repartition(tasks, *keys), b.repartition(tasks, *keys)
        return a.join(b, keys, how)

    if hot is None:
        return met(left, right, [on])
    one = F.lit(1)

    def dealt(side: DataFrame, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        row = F.xxhash64(*[F.col(f"`{c}`") for c in side.columns])
        return side.join(hot, on, "left").withColumn(mine, F.pmod(row, F.coalesce(F.col(own), one)).cast("int")).withColumn(
            theirs, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), one) - 1)))

    cut_left = dealt(left, "__cuts_l", "__cuts_r", "__cell_l", "__cell_r").withColumn(
        "__hot", F.col("__cuts_l").isNotNull()).drop("__cuts_l", "__cuts_r")
    cut_right = dealt(right, "__cuts_r", "__cuts_l", "__cell_r", "__cell_l").drop("__cuts_l", "__cuts_r").withColumn("__hit", F.lit(True))
    out = met(cut_left, cut_right, [on, "__cell_l", "__cell_r"])
    if how == "left":  # a hot key has matches: a cell without any is no missing match
        out = out.filter(~F.col("__hot") | F.col("__hit").isNotNull())
    return out.drop("__cell_l", "__cell_r", "__hot", "__hit")
