"""JOB1 on a stream: the per-row cleaning of raw records applied to a
Structured Streaming source.

The cleaning is one projection, so it runs unchanged on a streaming frame.
Documents that come twice are removed in one of two ways.  ``clean_stream`` keeps
state for a time the caller names (``within``).  ``clean_stream_once`` looks back over
all documents ever seen: what it has seen is a table of ids and row hashes that each
micro-batch is anti-joined with and extends, in the same commit as its rows.  Results
of the first go to a parquet sink with its
own checkpoint in the shared folder, so a restarted query resumes exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.batches import BatchTables
from ..plans.clean import clean_records
from ..session import scratch_path
from ..sources.adapter import raw_records_from_part


def clean_stream(stream: DataFrame, as_of=None, within: str | None = None) -> DataFrame:
    """Clean a streaming frame of raw records; with ``within`` (e.g. ``"1 hour"``,
    by arrival) exact duplicates go, without it no state is kept."""
    if within:
        seen = stream.columns
        stream = (stream.withColumn("__seen", F.current_timestamp()).withWatermark("__seen", within)
                  .dropDuplicatesWithinWatermark(seen).drop("__seen"))
    return clean_records(stream, as_of=as_of, dedupe="none")


def clean_stream_to_table(spark: SparkSession, source_dir: str, file_glob: str = "*.parquet", as_of=None,
                          out_path: str | None = None, within: str | None = None,
                          max_files: int | None = None) -> DataFrame:
    """Stream the part files matching ``file_glob`` in ``source_dir`` through
    the raw adapter and the cleaning into a parquet table (trigger
    availableNow: process what is there, then stop), and return the written
    table.  ``max_files`` bounds the files of one micro-batch (default: all
    there are)."""
    src = source_dir.rstrip("/")
    schema = spark.read.option("pathGlobFilter", file_glob).parquet(src).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    cleaned = clean_stream(raw_records_from_part(reader.parquet(src)), as_of, within)
    out = out_path or scratch_path(spark, "stream-clean")
    query = (
        cleaned.writeStream.format("parquet")
        .option("path", f"{out}/data")
        .option("checkpointLocation", f"{out}/_checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{out}/data")


#: (id, 128 bits of hash over the whole row): equal documents have equal marks.
_SEEN = "id string, h1 long, h2 long, bucket int"


def _marked(rows: DataFrame, id_col: str, buckets: int) -> DataFrame:
    """``rows`` with the mark each is told by."""
    parts = []
    for c in rows.columns:  # null and empty differ, and so do values that run together
        s = F.col(f"`{c}`").cast("string")
        parts.append(F.coalesce(F.concat(F.lit("="), s), F.lit("-")))
    mark = F.array(*parts)
    key = F.coalesce(F.concat(F.lit("="), F.col(f"`{id_col}`").cast("string")), F.lit("-"))
    return rows.withColumns({"__id": key, "__h1": F.xxhash64(F.lit(1), mark), "__h2": F.xxhash64(F.lit(2), mark),
                             "__bucket": F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")})


def clean_stream_once(spark: SparkSession, source_dir: str, out_path: str, stream: str, file_glob: str = "*.parquet", as_of=None,
                      max_files: int | None = None, id_col: str = "_id", buckets: int = 64, to_raw=raw_records_from_part) -> BatchTables:
    """JOB1 on a stream, exact duplicates removed over all time (AGG7).

    Each micro-batch is de-duplicated, anti-joined by an equal key with the marks of
    all earlier ones, and committed as one batch of two tables, ``cleaned`` and ``seen``,
    named by ``stream`` and the micro-batch's number: a batch that is run again after a
    failure finds itself in the ledger.  Several streams (deliveries) may follow one
    another into one folder.  ``seen`` is written by hash bucket, and the anti join
    reads only the buckets that occur in the batch."""
    tables, src = BatchTables(spark, out_path), source_dir.rstrip("/")
    schema = spark.read.option("pathGlobFilter", file_glob).parquet(src).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def one(batch: DataFrame, number: int) -> None:
        name = f"{stream}-{number}"
        if name in tables.batches():
            return
        rows = _marked(batch, id_col, buckets).dropDuplicates(["__id", "__h1", "__h2"])
        touched = [r[0] for r in rows.select("__bucket").distinct().collect()]  # at most ``buckets`` values
        seen = tables.read("seen", _SEEN).filter(F.col("bucket").isin(touched)).select(
            F.col("id").alias("__id"), F.col("h1").alias("__h1"), F.col("h2").alias("__h2"))
        fresh = rows.join(seen, ["__id", "__h1", "__h2"], "left_anti")
        marks = fresh.select(F.col("__id").alias("id"), F.col("__h1").alias("h1"), F.col("__h2").alias("h2"), F.col("__bucket").alias("bucket"))
        cleaned = clean_records(fresh.drop("__id", "__h1", "__h2", "__bucket"), as_of=as_of, dedupe="none")
        tables.append(name, {"cleaned": cleaned, "seen": marks.repartition("bucket").sortWithinPartitions("bucket")})

    query = (to_raw(reader.parquet(src)).writeStream.foreachBatch(one)
             .option("checkpointLocation", f"{out_path.rstrip('/')}/_checkpoint-{stream}").trigger(availableNow=True).start())
    query.awaitTermination()
    return tables
