"""Publishing by generation: what readers see changes by one rename.

Tables are written aside, below a folder of their own generation; a manifest that
names their folders is renamed into place at the end.  Readers go by the newest
manifest, so an export that dies between two tables leaves the old set whole, and a
reader never meets tables of two exports.  Works on any store whose rename does not
replace an existing file.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import remove_path


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def files(spark: SparkSession, folder: str, prefix: str) -> list[str]:
    """The paths in a folder whose names start with ``prefix``, sorted; a driver-side listing of one folder."""
    store, p = _at(spark, folder)
    if not store.exists(p):
        return []
    return sorted(s.getPath().toString() for s in store.listStatus(p) if s.getPath().getName().startswith(prefix))


def write_small(spark: SparkSession, path: str, text: str) -> str:
    """Write a short text (a manifest, a ledger entry) and return its path."""
    store, p = _at(spark, path)
    out = store.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return path


def read_small(spark: SparkSession, path: str) -> str:
    store, p = _at(spark, path)
    size = store.getFileStatus(p).getLen()
    with_stream = store.open(p)
    try:
        return bytes(with_stream.readNBytes(int(size))).decode()
    finally:
        with_stream.close()


def rename_new(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file to a name that must be new: of two writers one fails."""
    store, p = _at(spark, source)
    _, q = _at(spark, target)
    if store.exists(q) or not store.rename(p, q):
        raise FileExistsError(f"{target} was published by another writer")


class Publication:
    """A set of tables below ``path``, published together."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def manifests(self) -> list[str]:
        return files(self.spark, self.path, "manifest-")

    def current(self) -> dict[str, str]:
        """Table name -> folder, of the newest manifest; empty before the first."""
        found = self.manifests()
        return {name: f"{self.path}/{folder}" for name, folder in json.loads(read_small(self.spark, found[-1])).items()} if found else {}

    def publish(self, tables: dict[str, DataFrame], write: Callable[[DataFrame, str], None]) -> dict[str, str]:
        """Write every table aside with ``write(df, folder)``, then publish them all."""
        known = self.manifests()
        n = int(known[-1].rsplit("-", 1)[1]) + 1 if known else 1
        aside = f"gen-{n:06d}-{uuid.uuid4().hex[:8]}"  # a writer that died may have left one of the same number
        folders = {name: f"{aside}/{name}" for name in tables}
        for name, df in tables.items():
            write(df, f"{self.path}/{folders[name]}")
        text = json.dumps(folders)
        rename_new(self.spark, write_small(self.spark, f"{self.path}/_{aside}.manifest", text), f"{self.path}/manifest-{n:06d}")
        return self.current()

    def clean(self, keep: int = 1) -> None:
        """Delete all generations but the newest ``keep``, and what writers that
        died left; readers of an older generation must be done."""
        known = self.manifests()
        kept = {folder.split("/")[0] for m in known[-keep:] for folder in json.loads(read_small(self.spark, m)).values()}
        for m in known[:-keep]:
            remove_path(self.spark, m)
        for p in files(self.spark, self.path, "gen-") + files(self.spark, self.path, "_gen-"):
            if p.rsplit("/", 1)[1].split(".")[0].lstrip("_") not in kept:
                remove_path(self.spark, p)
