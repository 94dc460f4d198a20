"""Batches that are appended once, whole, or not at all (SNK4, and state kept over batches).

A batch may write to several tables.  Its rows are staged as parquet files of its own,
then one ledger entry, renamed into place, names the batch and makes them part of the
tables: readers go by the ledger.  A task that is repeated overwrites its own part
(Spark's commit protocol), a job that dies leaves files no one reads, and a batch
that is delivered again finds itself in the ledger and adds nothing.  A batch can be
taken back by a further entry.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import remove_path
from .materialize import observed_write
from .publish import files, read_small, rename_new, write_small


@dataclass(frozen=True)
class Entry:
    """A batch in the ledger; ``tables``: name -> (folder, rows)."""

    number: int
    batch: str
    tables: dict
    retracted: bool = False


class BatchTables:
    """Tables below ``path`` that batches append to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _entries(self) -> list[Entry]:
        return sorted((Entry(**json.loads(read_small(self.spark, p))) for p in files(self.spark, self.path, "ledger-")), key=lambda e: e.number)

    def batches(self) -> dict[str, Entry]:
        """The batches that count, in the order they came."""
        live: dict[str, Entry] = {}
        for e in self._entries():
            if e.retracted:
                live.pop(e.batch, None)
            else:
                live[e.batch] = e
        return live

    def _commit(self, known: list[Entry], batch: str, tables: dict, retracted: bool = False) -> Entry:
        entry = Entry(known[-1].number + 1 if known else 1, batch, tables, retracted)
        name = f"ledger-{entry.number:06d}"
        rename_new(self.spark, write_small(self.spark, f"{self.path}/_{name}-{uuid.uuid4().hex[:8]}", json.dumps(entry.__dict__)), f"{self.path}/{name}")
        return entry

    def append(self, batch: str, tables: dict[str, DataFrame]) -> Entry:
        """Append the tables' rows as batch ``batch``; one that is in the ledger adds
        nothing.  Rows are counted while they are written."""
        known, live = self._entries(), self.batches()
        if batch in live:
            return live[batch]
        staged = {}
        for name, df in tables.items():
            folder = f"staged-{uuid.uuid4().hex}/{name}"
            seen = observed_write(df, lambda rows, to=folder: rows.write.parquet(f"{self.path}/{to}"), rows=F.count(F.lit(1)))
            staged[name] = [folder, seen["rows"]]
        return self._commit(known, batch, staged)

    def retract(self, batch: str) -> None:
        """Take a batch back: readers no longer see its rows."""
        if batch in self.batches():
            self._commit(self._entries(), batch, {}, True)

    def read(self, table: str, schema: T.StructType | str, batch_column: str | None = None) -> DataFrame:
        """All rows of a table, with the batch of each on request."""
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        live = [(e.batch, e.tables[table][0]) for e in self.batches().values() if table in e.tables and e.tables[table][1]]
        if not live:
            out = self.spark.createDataFrame([], schema)
            return out.withColumn(batch_column, F.lit(None).cast("string")) if batch_column else out
        rows = self.spark.read.schema(schema).parquet(*[f"{self.path}/{folder}" for _, folder in live])
        if not batch_column:
            return rows
        # a row's folder names its batch
        place: Column = F.regexp_extract(F.input_file_name(), r"(staged-[0-9a-f]+)/", 1)
        return rows.withColumn("__place", place).join(F.broadcast(self.spark.createDataFrame(
            [(folder.split("/")[0], b) for b, folder in live], f"__place string, `{batch_column}` string")), "__place").drop("__place")

    def rows(self, table: str) -> int:
        """Rows of a table, from the ledger alone."""
        return sum(e.tables[table][1] for e in self.batches().values() if table in e.tables)

    def clean(self) -> None:
        """Delete staged files no ledger entry counts; no writer may be at work."""
        kept = {folder.split("/")[0] for e in self.batches().values() for folder, _ in e.tables.values()}
        for p in files(self.spark, self.path, "staged-") + files(self.spark, self.path, "_ledger-"):
            if p.rsplit("/", 1)[1] not in kept:
                remove_path(self.spark, p)
