"""CSV whose quoted values hold line ends, read in splits (SRC3 at size).

Spark reads such a file in one task, as a line end may lie inside a value and a split
cannot know.  Here it can: a line end is inside a value exactly if the quotes before it
are odd in number (a quote inside a value is doubled).  One pass counts the quotes of
every split; prefix sums over the splits of a file, a few numbers each, tell every
split how it begins.  A second pass streams the lines of each split into records.  What
a split's first lines belong to, and what its last record lacks, are fragments, at most
two a split, that are put together by the order of the splits.  Each record is then
parsed by Spark's own parser.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import broadcast_budget, maybe_broadcast
from ..operators.materialize import materialize

_RECORDS = "file string, block long, part string, open boolean, value string"


def _records(batches):
    """Rows (file, block, odd, value) of whole splits in order: (file, block, part, open, value).

    ``part``: ``whole`` for a record that lies in the split, ``head`` for lines that end
    a record begun before it, ``tail`` for one that goes on behind it; ``open`` tells a
    head that does not end in the split either; ``first`` is a whole record, the file's first."""
    at, odd, held, head, fresh, out = None, False, [], False, False, []

    def row(part, is_open, value):
        out.append((at[0], at[1], part, is_open, value))

    def made():
        if out:
            kinds = (pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["file", "block", "part", "open", "value"])
            out.clear()

    def end():
        if at is None:
            return
        if head:
            row("head", True, "\n".join(held))
        elif held:
            row("tail", True, "\n".join(held))

    for batch in batches:
        quotes = pc.count_substring(batch.column(3), '"').to_pylist()
        for file, block, begins_odd, line, n in zip(*[c.to_pylist() for c in batch.columns], quotes):
            if (file, block) != at:
                end()
                at, odd, held, head = (file, block), begins_odd, [], begins_odd
                fresh = block == 0
            held.append(line)
            odd ^= bool(n & 1)
            if not odd:
                value = "\n".join(held)
                row("head" if head else "first" if fresh else "whole", False, value)
                held, head, fresh = [], False, False
        yield from made()
    end()
    yield from made()


def split_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """(value): the text of every record, without the files' header records.  A quote that is
    never closed takes the rest of its file into one record, as in any reader."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counts = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select(F.col("file").alias("f2"), F.col("block").alias("b2"), (F.pmod(F.coalesce(F.sum("quotes").over(before), F.lit(0)), F.lit(2)) == 1).alias("odd"))
    # a row per split
    begins = materialize(begins, "csv-splits", size=F.sum(F.octet_length("f2") + 40))
    size = int(begins.metrics["size"] or 0)
    marked = lines.withColumn("line", F.monotonically_increasing_id()).join(
        maybe_broadcast(begins.df, size), (F.col("file") == F.col("f2")) & (F.col("block") == F.col("b2")))
    if not 0 <= size <= broadcast_budget(spark):  # joined by a shuffle: a split's lines together again
        marked = marked.repartition("file", "block")
    ordered = marked.sortWithinPartitions("file", "block", "line").select("file", "block", "odd", "value")
    made = ordered.mapInArrow(_records, _RECORDS)
    whole = made.filter(F.col("part").isin("whole", *([] if header else ["first"]))).select("value")
    # at most two a split; a tail begins a record, the heads behind it go on with it
    order = F.struct("block", (F.col("part") == "tail").alias("tail"))
    number = F.sum((F.col("part") == "tail").cast("int")).over(Window.partitionBy("file").orderBy(order))
    pieces = made.filter(F.col("part").isin("head", "tail")).withColumn("number", number)
    joined = pieces.groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct(order.alias("at"), "value"))).alias("parts"))
    cut = joined.select(F.array_join(F.col("parts.value"), "\n").alias("value"))
    return whole.unionByName(cut).select(F.regexp_replace("value", "\r$", "").alias("value")).filter(F.col("value") != "")


def read_csv_split(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True) -> DataFrame:
    """A headed CSV directory with doubled quotes (``write_csv``'s exact quoting), large
    files read by as many tasks as they have splits; the rows of ``read_csv``, in no
    order.  A header record must lie in the first split of its file."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields)
    parsed = F.from_csv("value", ddl, {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"})
    return split_records(spark, path, header).select(parsed.alias("r")).select("r.*")
