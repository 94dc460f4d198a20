"""A stored registry of surrogate keys that deliveries extend (KEY1, KEY3 over time).

``assign_dense_key`` numbers one table; an id is then a row's place in an order, and
one new row moves all that follow.  A registry keeps the ids it has given: a
delivery's natural keys are looked up by an anti join, those not known get the next
dense numbers in their own order, and what was numbered before stays as it is.

The registry is a folder of numbered generations, ``gen-000001`` and so on, each the
keys one delivery added, and one small ledger per generation that names the delivery
and the range of its ids.  A ledger is renamed into place after its generation is
written whole, so a delivery that dies half way leaves nothing that readers see, and
one that is repeated adds nothing.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import remove_path
from .keys import assign_dense_key
from .publish import files, read_small, rename_new, write_small


@dataclass(frozen=True)
class Delivery:
    """One entry of the ledger: ids ``first .. first + rows - 1`` came with it."""

    name: str
    generation: int
    first: int
    rows: int


class Ledger:
    """Generations below ``path`` and the ledger that names them, whatever they hold."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def deliveries(self) -> list[Delivery]:
        """The ledger, in order."""
        found = [json.loads(read_small(self.spark, p)) for p in files(self.spark, self.path, "ledger-")]
        return sorted((Delivery(**d) for d in found), key=lambda d: d.generation)

    def _generation(self, n: int) -> str:
        return f"{self.path}/gen-{n:06d}"

    def _commit(self, made: Delivery) -> Delivery:
        text, name = json.dumps(made.__dict__), f"ledger-{made.generation:06d}"
        rename_new(self.spark, write_small(self.spark, f"{self.path}/_{name}", text), f"{self.path}/{name}")
        return made

    def remove(self) -> None:
        remove_path(self.spark, self.path)


class KeyRegistry(Ledger):
    """Natural keys (``columns``, a schema) and their ids (``key``) below ``path``.

    One writer at a time: of two that extend at once, the second to commit fails
    and, run again, numbers after the first.  Null is a value of a key like any
    other.  The id of a key that is delivered again never changes.
    """

    def __init__(self, spark: SparkSession, path: str, columns: T.StructType | str, key: str, start: int = 0):
        super().__init__(spark, path)
        self.key, self.start = key, start
        self.schema = T.StructType.fromDDL(columns) if isinstance(columns, str) else columns

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    def keys(self, upto: str | None = None) -> DataFrame:
        """All keys and ids, or those known after delivery ``upto``."""
        table = T.StructType([*self.schema.fields, T.StructField(self.key, T.LongType())])
        known = self.deliveries()
        if upto is not None:
            last = next(d.generation for d in known if d.name == upto)
            known = [d for d in known if d.generation <= last]
        paths = [self._generation(d.generation) for d in known if d.rows]
        return self.spark.read.schema(table).parquet(*paths) if paths else self.spark.createDataFrame([], table)

    def _same(self, names: dict[str, str]):
        """Equality, null for null, of a frame's columns with those of :meth:`_known`."""
        same = F.lit(True)
        for own, other in names.items():
            same = same & F.col(f"`{other}`").eqNullSafe(F.col(f"`__k_{own}`"))
        return same

    def _known(self) -> DataFrame:
        return self.keys().select(*[F.col(f"`{c}`").alias(f"__k_{c}") for c in self.names], F.col(self.key).alias("__id"))

    def extend(self, rows: DataFrame, delivery: str, on: dict[str, str] | None = None) -> Delivery:
        """Number the keys of ``rows`` that are not known yet, in their order, after
        the highest id so far.  ``on``: key column -> column of ``rows`` where the
        names differ.  A delivery that is in the ledger adds nothing."""
        known = self.deliveries()
        for d in known:
            if d.name == delivery:
                return d
        on = {c: (on or {}).get(c, c) for c in self.names}
        fresh = rows.select(*[F.col(f"`{on[f.name]}`").cast(f.dataType).alias(f.name) for f in self.schema.fields]).distinct()
        if known:
            there = self._known()
            fresh = fresh.join(there, self._same({c: c for c in self.names}), "left_anti")
        first = known[-1].first + known[-1].rows if known else self.start
        numbered = assign_dense_key(fresh, self.names, self.key, start=first, front=False, ties="none")
        made = Delivery(delivery, known[-1].generation + 1 if known else 1, first, numbered.rows)
        target = self._generation(made.generation)
        if numbered.rows:
            # what a writer that died before its ledger left behind is not listed: replace it
            numbered.df.write.mode("overwrite").parquet(target)
        numbered.remove()
        return self._commit(made)

    def attach(self, rows: DataFrame, on: dict[str, str] | None = None, how: str = "inner") -> DataFrame:
        """``rows`` with the id of their key, by an equal-key join; a key held by many
        rows is cut by AQE's skew join.  ``how="left"`` keeps rows of unknown keys."""
        on = {c: (on or {}).get(c, c) for c in self.names}
        there = self._known()
        out = rows.drop(self.key).join(there, self._same(on), how)
        return out.withColumn(self.key, F.col("__id")).drop("__id", *[f"__k_{c}" for c in self.names])
