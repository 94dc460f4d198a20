"""Deterministic surrogate keys (KEY1-KEY3).

The reference numbers rows with ``monotonically_increasing_id``, which is
neither dense nor stable between actions.  Here a key is the row's position in
a total order over natural-key columns, 0-based (or ``start``-based):

1. ``orderBy(order)`` range-partitions and sorts (one shuffle, no single task);
2. ``monotonically_increasing_id`` then reads (partition index, row number
   within the partition) off every row;
3. the sorted rows are written as parquet into the shared checkpoint folder,
   so the counting pass and the numbering pass see the very same rows even if
   an executor is lost in between;
4. rows per partition are counted (one row per partition comes back, a size
   bounded by the partition count, not by the data) and turned into running
   offsets;
5. the offsets are broadcast-joined once and the numbered table is written: later
   reads prune its columns, push filters on the key into the scan, and join
   nothing to get it.

When the order columns are a natural key the result equals
``row_number() OVER (ORDER BY order) - 1`` exactly; rows tied on every order
column must be identical for the result to be deterministic, so order by all
columns when no natural key exists.  Ties are broken by the row's position in
the input, so that a value shared by a third of all rows is spread over many
range partitions instead of landing in one sort task.  A position is only the
same in a repeated task if the input's rows come in a fixed order: a scan's do,
a shuffle's do not, so other inputs are written first (``ties``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import remove_path, scratch_path

_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


@dataclass
class Keyed:
    """A keyed table with its row count; its data size is measured on demand.

    The keys of ``df`` are exactly ``start .. start + rows - 1``, unless it is not
    ``dense``: keys of a registry, of which a table may hold some.
    """

    df: DataFrame
    key: str
    rows: int
    start: int = 0
    _bytes: int | None = None
    path: str | None = None
    table: str | None = None
    dense: bool = True

    def remove(self) -> None:
        """Delete the written table; ``df`` cannot be read afterwards."""
        if self.table:
            self.df.sparkSession.sql(f"DROP TABLE IF EXISTS {self.table}")
        if self.path:
            remove_path(self.df.sparkSession, self.path)

    @property
    def data_bytes(self) -> int:
        """Bytes of the table's values (strings by their real length): one
        aggregate over the written table, computed once."""
        if self._bytes is None:
            self._bytes = int(self.df.agg(F.sum(_row_bytes(self.df.schema))).first()[0] or 0)
        return self._bytes

    def key_in_range(self, c) -> "F.Column":
        """Membership in this table's key set, as a plain predicate."""
        if not self.dense:
            raise ValueError("the keys of this table are no whole range: join them")
        col = F.col(c) if isinstance(c, str) else c
        return col.between(F.lit(self.start), F.lit(self.start + self.rows - 1))


def _row_bytes(schema: T.StructType):
    """Per-row size in Spark's binary row layout: a null bitmap word per 64
    fields, an 8-byte slot per field, and variable-length data (strings by
    their real length, arrays by element count) rounded up to 8 bytes."""
    n = len(schema.fields)
    total = F.lit(8 * ((n + 63) // 64) + 8 * n).cast("long")
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            var = F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, T.ArrayType):
            var = F.lit(16) + F.coalesce(F.size(c), F.lit(0)) * 16
        else:
            continue
        total = total + F.ceil(var / 8) * 8
    return total


def assign_dense_key(
    df: DataFrame,
    order: list[str],
    key: str,
    start: int = 0,
    front: bool = True,
    buckets: int | None = None,
    measure_bytes: bool = False,
    ties: str = "write",
) -> Keyed:
    """Add a dense, deterministic 64-bit key ordered by ``order`` (asc, nulls first).

    ``ties`` says how rows equal on all of ``order`` are told apart:
    ``"write"`` (default) writes the input first and takes the position there;
    ``"scan"`` takes the position in the input, which must be a plain scan or a
    projection of one; ``"none"`` is for inputs without such rows (a DISTINCT of
    the order columns).

    With an empty ``order`` the key follows the input's own partition and row
    order (what ``monotonically_increasing_id`` numbers, made dense) and the
    input is never shuffled: the cheapest key for a large table whose natural
    order does not matter.  It is fixed once written, and it repeats for the
    same input files and split size.

    With ``buckets`` the numbered table is written bucketed by the key into that
    many buckets and registered in the session catalog: later joins and
    groupings on the key read it without shuffling it.  ``measure_bytes``
    measures the table's size in the counting pass (for tables that may be
    broadcast), instead of in a separate job later.
    """
    if ties not in ("write", "scan", "none"):
        raise ValueError("ties must be 'write', 'scan' or 'none'")
    spark: SparkSession = df.sparkSession
    cols = df.columns
    sorted_path = scratch_path(spark, f"sorted-{key}")
    given = None
    if order:
        if ties == "write":
            given = scratch_path(spark, f"rows-{key}")
            df.write.parquet(given)
            df = spark.read.schema(df.schema).parquet(given)
        sort_keys = [F.col(f"`{c}`").asc_nulls_first() for c in order]
        if ties != "none":
            df, sort_keys = df.withColumn("__tie", F.monotonically_increasing_id()), [*sort_keys, F.col("__tie")]
        df = df.orderBy(*sort_keys).drop("__tie")
    ordered = df.withColumn("__mid", F.monotonically_increasing_id())
    ordered.write.parquet(sorted_path)
    ordered = spark.read.schema(ordered.schema).parquet(sorted_path)
    pid = F.shiftright("__mid", _ROW_BITS)
    aggs = [F.count(F.lit(1)).alias("n")]
    if measure_bytes:
        # size of the rows as they will be read: the key's 8 bytes included
        key_field = T.StructType([T.StructField(key, T.LongType())] + [f for f in df.schema.fields if f.name != key])
        aggs.append(F.sum(_row_bytes(key_field)).alias("b"))
    counts = ordered.groupBy(pid.alias("__pid")).agg(*aggs).collect()
    offsets, running, measured = [], 0, 0
    for r in sorted(counts, key=lambda r: r["__pid"]):
        offsets.append((r["__pid"], running + start))
        running += r["n"]
        measured += (r["b"] or 0) if measure_bytes else 0
    off_schema = "__pid long, __off long"
    off_df = spark.createDataFrame(offsets, off_schema) if offsets else spark.createDataFrame([], off_schema)
    keyed = ordered.withColumn("__pid", pid).join(F.broadcast(off_df), "__pid")
    key_col = (F.col("__off") + F.col("__mid").bitwiseAND(F.lit(_ROW_MASK))).alias(key)
    out_cols = [F.col(f"`{c}`") for c in cols if c != key]
    out = keyed.select(key_col, *out_cols) if front else keyed.select(*out_cols, key_col)
    path, table = scratch_path(spark, f"keyed-{key}"), None
    if buckets:
        # the repartition uses the bucketing hash: each task writes one bucket
        table = "starloom_" + path.rstrip("/").rsplit("/", 1)[-1].replace("-", "_")
        out.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
        numbered = spark.table(table)
    else:
        out.write.parquet(path)
        numbered = spark.read.schema(out.schema).parquet(path)
    for done in (sorted_path, given):
        if done:
            remove_path(spark, done)
    return Keyed(numbered, key, running, start, measured if measure_bytes else None, path, table)


def renumber(df: DataFrame, order: list[str], key: str, start: int = 1) -> Keyed:
    """KEY2: replace ``key`` by a dense 1..N numbering in ``order``."""
    return assign_dense_key(df.drop(key), order, key, start=start, front=False)


def running_sum(df: DataFrame, order: str, n: str, out: str) -> Keyed:
    """``df`` with ``out``, the sum of ``n`` over all rows before it in the order of the
    column ``order`` (ties in any order, each row once), nulls first.  The rows are sorted
    by ranges and written; one sum per partition comes to the driver, and each partition
    adds up its own.  ``rows`` of the result is the sum over all rows."""
    spark = df.sparkSession
    sorted_path, path = scratch_path(spark, f"sorted-{out}"), scratch_path(spark, f"summed-{out}")
    df.orderBy(F.col(order).asc_nulls_first()).withColumn("__mid", F.monotonically_increasing_id()).write.parquet(sorted_path)
    ordered = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("__mid", T.LongType())])).parquet(sorted_path)
    ordered = ordered.withColumn("__pid", F.shiftright("__mid", _ROW_BITS))
    offsets, running = [], 0
    for r in sorted(ordered.groupBy("__pid").agg(F.sum(n).alias("s")).collect(), key=lambda r: r["__pid"]):
        offsets.append((r["__pid"], running))
        running += r["s"] or 0
    off_df = F.broadcast(spark.createDataFrame(offsets, "__pid long, __off long"))
    before = Window.partitionBy("__pid").orderBy("__mid").rowsBetween(Window.unboundedPreceding, -1)
    summed = ordered.withColumn("__own", F.coalesce(F.sum(n).over(before), F.lit(0))).join(off_df, "__pid")
    summed.select(*df.columns, (F.col("__off") + F.col("__own")).alias(out)).write.parquet(path)
    remove_path(spark, sorted_path)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.LongType())])
    return Keyed(spark.read.schema(schema).parquet(path), order, running, path=path, dense=False)
