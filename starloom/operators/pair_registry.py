"""A stored registry of ids of pairs, which keeps the rows that pair up, not the pairs.

Rows of a delivery that share a value (a title) pair up: m rows of one value make
m x m pairs.  As in ``KeyRegistry``, a pair gets its id with the first delivery that has
it, after all ids of the deliveries before and in the order of its two keys, and keeps
it.  A generation holds the rows of its delivery only; all ids follow from them:

* Keys with the same history (the values they had, and in which deliveries) are of one
  kind: they pair with the same keys, and each of these pairs came with the same
  delivery, the first in which both kinds had a common value.
* The keys that a kind met first with delivery e are its view of e.  The id of a pair is
  the number of pairs numbered before its left key's view, plus the place of the right
  key in the view, and views are shared by all keys of a kind.

So what is sorted, shuffled and written is a row per key and kind that it meets: a title
has few kinds (two deliveries: three), and never more of these rows than pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .key_registry import Delivery, Ledger
from .keys import Keyed, assign_dense_key, running_sum
from .materialize import Written, materialize


@dataclass
class PairNumbers:
    """``kinds``: (left, right, __kind) of each key.  ``places``: (__at, __kind, __gen,
    right), the keys that a kind met first with a generation.  ``bases``: (left, __gen,
    __base): the id of a pair is ``__base + __at``.  ``pairs`` is how many there are."""

    kinds: Written
    places: Keyed
    bases: Written
    pairs: int

    def remove(self) -> None:
        for table in (self.kinds, self.places, self.bases):
            table.remove()


class PairRegistry(Ledger):
    """Ids of the pairs (``left`` of one row, ``right`` of another) of rows equal on
    ``on``.  ``sides`` is the schema of these columns; ``left`` is an id of ``right`` (of
    a ``KeyRegistry``), so one names the other.  Null is a right key like any other; a
    null ``on`` pairs with nothing.  One writer at a time, as in ``KeyRegistry``."""

    def __init__(self, spark: SparkSession, path: str, sides: T.StructType, on: str, left: str, right: str, start: int = 0):
        super().__init__(spark, path)
        self.sides, self.on, self.left, self.right, self.start = sides, on, left, right, start
        self._last: tuple[int, Written, Written] | None = None

    def extend(self, rows: DataFrame, delivery: str) -> Delivery:
        """Keep the rows of a delivery and number the pairs that are new with it.  A
        delivery that is in the ledger adds nothing."""
        known = self.deliveries()
        for d in known:
            if d.name == delivery:
                return d
        n = known[-1].generation + 1 if known else 1
        own = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.sides.fields])
        # what a writer that died before its ledger left behind is not listed: replace it
        own.filter(F.col(self.on).isNotNull()).distinct().withColumn("__gen", F.lit(n)).write.mode("overwrite").parquet(self._generation(n))
        first = known[-1].first + known[-1].rows if known else self.start
        kinds, met = self._met([*known, Delivery(delivery, n, first, 0)])
        made = self._commit(Delivery(delivery, n, first, self._pairs(kinds, met) - (first - self.start)))
        self._last = n, kinds, met
        return made

    def _met(self, known: list[Delivery]) -> tuple[Written, Written]:
        """Each key with its kind and the history that makes it, (on, generations) of every
        value it had; and (__kind, __other, __gen): the kinds that each kind pairs with, and
        the first generation in which they had a common value."""
        table = T.StructType([*self.sides.fields, T.StructField("__gen", T.IntegerType())])
        rows = self.spark.read.schema(table).parquet(*[self._generation(d.generation) for d in known])
        per = rows.groupBy(self.left, self.right, self.on).agg(F.sort_array(F.collect_list("__gen")).alias("__gens"))
        held = F.sort_array(F.collect_list(F.struct(F.col(self.on).alias("__on"), "__gens")))
        keys = per.groupBy(self.left, self.right).agg(held.alias("__held"))
        kinds = materialize(keys.withColumn("__kind", F.sha2(F.to_json("__held"), 256)), "pair-kinds")
        one = kinds.df.groupBy("__kind").agg(F.first("__held").alias("__held")).select("__kind", F.explode("__held").alias("__h"))
        one = one.select("__kind", F.col("__h.__on").alias("__on"), F.col("__h.__gens").alias("__gens"))
        two = one.select(F.col("__kind").alias("__other"), "__on", F.col("__gens").alias("__theirs"))
        common = F.array_min(F.array_intersect("__gens", "__theirs"))
        met = one.join(two, "__on").select("__kind", "__other", common.alias("__gen")).filter(F.col("__gen").isNotNull())
        return kinds, materialize(met.groupBy("__kind", "__other").agg(F.min("__gen").alias("__gen")), "pair-met")

    @staticmethod
    def _pairs(kinds: Written, met: Written) -> int:
        """How many pairs there are, from the sizes of the kinds."""
        sizes = kinds.df.groupBy("__kind").agg(F.count(F.lit(1)).alias("__m"))
        other = sizes.select(F.col("__kind").alias("__other"), F.col("__m").alias("__n"))
        return met.df.join(sizes, "__kind").join(other, "__other").agg(F.sum(F.col("__m") * F.col("__n"))).first()[0] or 0

    def numbers(self) -> PairNumbers:
        """Of all deliveries in the ledger; the caller removes it."""
        known = self.deliveries()
        if self._last and self._last[0] == known[-1].generation:  # as just extended
            _, kinds, met = self._last
        else:
            kinds, met = self._met(known)
        self._last = None
        own = kinds.df.select(F.col("__kind").alias("__other"), self.right)
        views = met.df.join(own, "__other").select("__kind", "__gen", self.right)
        places = assign_dense_key(views, ["__kind", "__gen", self.right], "__at", ties="none")
        met.remove()
        per = places.df.groupBy("__kind", "__gen").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
        each = kinds.df.select("__kind", self.left).join(per, "__kind")
        before = running_sum(each.select(self.left, "__gen", "__first", "__n", F.struct("__gen", self.left).alias("__order")), "__order", "__n", "__before")
        bases = materialize(before.df.select(self.left, "__gen", (F.col("__before") - F.col("__first") + self.start).alias("__base")), "pair-bases")
        before.remove()
        return PairNumbers(kinds, places, bases, before.rows)
